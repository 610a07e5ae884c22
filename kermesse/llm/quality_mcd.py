"""Quality rules: fixed limits, then robust multivariate outliers per language and source."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kermesse.llm.common import bounded, python_ready, slices, staged
from kermesse.llm.text_stats import base_stats

MIN_WORDS = 50
#: Share of the rows of a group that the covariance determinant is minimised over, and the rows a group needs.
HALF, MIN_ROWS, STEPS = 0.75, 30, 5
#: A clean row lies farther out with this probability, were its group normal.
TAIL = 1e-4
#: Transformed statistics and the least standard deviation that a group is given for each.
FLOORS = {"word_length": 0.12, "symbol_rate": 0.35, "dup_line_rate": 0.15, "repeat_rate": 0.12}
AXES = list(FLOORS)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Groups whose estimates are broadcast; beyond, they are joined by a shuffle.
BROADCAST_GROUPS = 200_000


def chi2_cdf(x: float, k: int) -> float:
    term = total = 1.0 / math.gamma(k / 2 + 1)
    for n in range(1, 500):
        term *= x / 2 / (k / 2 + n)
        total += term
    return total * (x / 2) ** (k / 2) * math.exp(-x / 2)


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return low


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text."""
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [base_stats(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "lang", "source")]
                + [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))],
                ["doc_id", "lang", "source", *COUNTS])

    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"),
                       F.col("text").cast("string")).mapInArrow(count, schema)


def transformed() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {"word_length": F.log((F.col("word_chars") + 1) / n), "symbol_rate": F.log(F.col("n_symbols") / n + 0.05),
            "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
            "repeat_rate": F.col("n_repeat_words") / n}


def named(*columns: str) -> Column:
    """A group's key: its columns and their values, nulls as such, so that no group has the key of another or of a pool."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def distance() -> Column:
    """Squared Mahalanobis distance of the axes from `_mu` under the inverse covariance `_inv` (row by row)."""
    off = [F.col(a) - F.col("_mu")[i] for i, a in enumerate(AXES)]
    return sum((off[i] * off[j] * F.col("_inv")[i * len(AXES) + j] for i in range(len(AXES)) for j in range(len(AXES))),
               F.lit(0.0))


def inverse(cov: np.ndarray, factor: float) -> np.ndarray:
    """Inverse of the covariance, no direction narrower than the floors."""
    floors = np.array(list(FLOORS.values()))
    values, vectors = np.linalg.eigh(cov * factor / np.outer(floors, floors))
    return (vectors / np.maximum(values, 1.0)) @ vectors.T / np.outer(floors, floors)


def estimates(sums: DataFrame, factor: float) -> DataFrame:
    """`_g`, `_mu`, `_inv` from the sums of a group's chosen rows."""
    k = len(AXES)

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for r in part.itertuples(index=False):
                mu = np.array(r[2]) / r[1]
                square = np.zeros((k, k))
                square[np.triu_indices(k)] = np.array(r[3]) / r[1]
                square = np.triu(square) + np.triu(square, 1).T
                out.append((r[0], mu.tolist(), inverse(square - np.outer(mu, mu), factor).ravel().tolist()))
            yield pd.DataFrame(out, columns=["_g", "_mu", "_inv"])

    return sums.mapInPandas(solve, "_g string, _mu array<double>, _inv array<double>")


def concentrated(rows: DataFrame, params: DataFrame, share: float | None, limit: float | None, factor: float) -> DataFrame:
    """One concentration step: estimates from each group's `share` of nearest rows, or those within `limit`.

    Distances fall in narrow logarithmic bins, and sums are kept per group and bin, so one pass with partial sums
    serves groups of any size; the share is rounded up to whole bins.
    """
    k = len(AXES)
    near = rows.join(params, "_g").withColumn("_d", distance())
    binned = near.withColumn("_bin", F.floor(F.log2(F.greatest("_d", F.lit(1e-6))) * 64).cast("int"))
    sums = [F.count(F.lit(1)).alias("_m"), *[F.sum(a).alias(f"_s{i}") for i, a in enumerate(AXES)],
            *[F.sum(F.col(AXES[i]) * F.col(AXES[j])).alias(f"_q{i}_{j}") for i in range(k) for j in range(i, k)]]
    bins = binned.groupBy("_g", "_bin").agg(*sums)
    if share is not None:
        upto = Window.partitionBy("_g").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = (bins.withColumns({"_before": F.coalesce(F.sum("_m").over(upto), F.lit(0)),
                                  "_all": F.sum("_m").over(Window.partitionBy("_g"))})
                .where(F.col("_before") < F.col("_all") * share))
    else:
        bins = bins.where(F.col("_bin") < math.floor(math.log2(limit) * 64))
    total = bins.groupBy("_g").agg(F.sum("_m").alias("_m"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(k)],
                                   *[F.sum(f"_q{i}_{j}").alias(f"_q{i}_{j}") for i in range(k) for j in range(i, k)])
    vectors = total.select("_g", F.col("_m").cast("double"), F.array(*[f"_s{i}" for i in range(k)]).alias("_sum"),
                           F.array(*[f"_q{i}_{j}" for i in range(k) for j in range(i, k)]).alias("_square"))
    return bounded(staged(estimates(vectors, factor)), BROADCAST_GROUPS)


def quality_outliers(docs: DataFrame, half: float = HALF, steps: int = STEPS, min_rows: int = MIN_ROWS,
                     tail: float = TAIL, min_words: int = MIN_WORDS) -> DataFrame:
    """One row a document: `doc_id`, `lang`, `source`, the counts, `base_failed`, `distance`, `kept`.

    Rows under `min_words` words, or with over half of their words in repeated windows, fail. The rest are judged
    per language and source: a minimum-covariance-determinant estimate starts from medians and quartiles, repeats
    concentration steps over all rows of the group, is reweighted once, and rejects rows whose squared Mahalanobis
    distance passes the chi-square quantile of 1 - `tail`. Sources with under `min_rows` rows share the estimate
    of the small sources of their language. No direction is taken narrower than FLOORS, so a constant statistic
    rejects nothing. The group sums are reduced before every shuffle: one source may hold any share of the rows.

    Null text: zero counts, failed. Null lang or source: a group of its own. Repeated rows each get a row, no rows
    give no rows, other columns are ignored.
    """
    python_ready(docs.sparkSession)
    k = len(AXES)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    base = staged(counted(docs).withColumn("base_failed", failed).withColumns(transformed())
                  .withColumn("_own", named("lang", "source")))
    judged = base.where("not base_failed")
    large = bounded(staged(judged.groupBy("_own").count().where(F.col("count") >= min_rows).select("_own", F.lit(True).alias("_large"))),
                    BROADCAST_GROUPS)
    group = F.when(F.col("_large"), F.col("_own")).otherwise(named("lang"))
    grouped = base.join(large, "_own", "left").withColumn("_g", group)
    rows = grouped.where("not base_failed").select("_g", *AXES)
    start = rows.groupBy("_g").agg(*[F.percentile_approx(a, [0.25, 0.5, 0.75], 2000).alias(f"_p{i}") for i, a in enumerate(AXES)])
    scale = [F.greatest((F.col(f"_p{i}")[2] - F.col(f"_p{i}")[0]) / 1.349, F.lit(f)) for i, f in enumerate(FLOORS.values())]
    params = bounded(staged(start.select(
        "_g", F.array(*[F.col(f"_p{i}")[1] for i in range(k)]).alias("_mu"),
        F.array(*[1 / scale[i] ** 2 if i == j else F.lit(0.0) for i in range(k) for j in range(k)]).alias("_inv"))), BROADCAST_GROUPS)
    factor = half / chi2_cdf(chi2_quantile(half, k), k + 2)
    for _ in range(steps):
        params = concentrated(rows, params, half, None, factor)
    cut = chi2_quantile(0.975, k)
    params = concentrated(rows, params, None, cut, 0.975 / chi2_cdf(cut, k + 2))
    told = grouped.join(params, "_g", "left").withColumn("distance", F.when(~F.col("base_failed"), distance()))
    # A group none of whose rows is near its centre has no reweighted estimate: its rows stay.
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= chi2_quantile(1 - tail, k))
    return told.select("doc_id", "lang", "source", *COUNTS, "base_failed", "distance", kept.alias("kept"))
