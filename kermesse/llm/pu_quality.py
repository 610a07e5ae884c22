"""Quality classifier learnt from trusted positives and unlabelled text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.llm.common import python_ready, slices, staged
from kermesse.llm.text_stats import base_stats

#: Newton steps of a fit, weight of the squared weights, and score bins of the prior's estimate.
STEPS, RIDGE, BINS = 12, 1e-3, 1000
FEATURES = ("f_length", "f_word", "f_symbols", "f_upper", "f_digits", "f_marks", "f_repeat", "f_double", "f_lines",
            "f_distinct", "f_short", "f_tail")


def features(text: str | None) -> tuple[float, ...]:
    """Statistics of a whole text, each of the order of 1; an empty text has zeros and `f_short` 1."""
    n, chars, symbols, lines, again, repeats = base_stats(text)
    if not n:
        return 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0
    words = text.encode().split()
    lower = text.lower()
    letters = sum(map(str.__ne__, text, lower)) if text != lower else 0
    ends = sum(w[-1] in b"#*$%&|<>!" for w in words)
    return (math.log1p(n) / 5, min(chars / n / 5, 3.0), min(symbols / n, 3.0), letters / chars * 2,
            sum(map(text.count, "0123456789")) / chars * 5, min((text.count("!") + text.count("?")) / n, 3.0), repeats / n,
            sum(map(bytes.__eq__, words, words[1:])) / n, again / max(lines, 1), len(set(words)) / n, math.exp(-n / 20), ends / n)


def featured(docs: DataFrame) -> DataFrame:
    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array([r[i] for r in rows], pa.float64()) for i in range(len(FEATURES))]],
                ["doc_id", *FEATURES])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(compute, schema)


class Linear:
    """Weights over standardised features; the last one is the constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    def inputs(self) -> list[Column]:
        return [(F.col(f) - float(m)) / float(s) for f, m, s in zip(FEATURES, self.mean, self.scale)] + [F.lit(1.0)]

    def margin(self) -> Column:
        raw = self.weights[:-1] / self.scale
        return sum((F.col(f) * float(w) for f, w in zip(FEATURES, raw)), F.lit(float(self.weights[-1] - raw @ self.mean)))

    def score(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))


def fitted(rows: DataFrame, prior: float, steps: int = STEPS, ridge: float = RIDGE) -> Linear:
    """Minimise prior * R_p+ + max(0, R_u- - prior * R_p-) with the logistic loss over all rows.

    Each Newton step is one pass of partial sums: losses, gradients and the curvature. While the estimated negative
    risk is below zero, the step goes the other way on it, as the non-negative estimator asks.
    """
    stats = rows.agg(*[F.avg(f) for f in FEATURES], *[F.stddev_pop(f) for f in FEATURES]).first()
    k = len(FEATURES)
    if stats[0] is None:
        return Linear(np.zeros(k), np.ones(k), np.zeros(k + 1))
    mean, scale = np.array(stats[:k]), np.maximum(np.array(stats[k:]), 1e-2)
    model, best = Linear(mean, scale, np.zeros(k + 1)), (math.inf, None)
    upper = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    for _ in range(steps):
        g = F.col("_g")
        x = [F.col(f"_x{i}") for i in range(k + 1)]
        p, trust = F.col("_p"), F.col("_trusted")
        at = rows.select("_trusted", model.margin().alias("_g"), *[c.alias(f"_x{i}") for i, c in enumerate(model.inputs())])
        at = at.withColumn("_p", 1 / (1 + F.exp(-g)))
        soft = F.greatest(g, F.lit(0.0)) + F.log1p(F.exp(-F.abs(g)))  # loss of calling a row negative
        one = lambda c: F.sum(F.when(trust, c).otherwise(0.0))
        sums = at.agg(F.count(F.lit(1)), one(F.lit(1.0)), F.sum(soft), one(soft), one(soft - g),
                      *[F.sum(p * c) for c in x], *[one(p * c) for c in x], *[one((1 - p) * c) for c in x],
                      *[F.sum(p * (1 - p) * x[i] * x[j]) for i, j in upper]).first()
        n, n_p = float(sums[0]), float(sums[1])
        if not n_p:
            break
        u, pm, pp = (np.array(sums[5 + (k + 1) * i:5 + (k + 1) * (i + 1)], float) for i in range(3))
        negative = sums[2] / n - prior * sums[3] / n_p
        risk = prior * sums[4] / n_p + max(0.0, negative) + ridge * float(model.weights[:-1] @ model.weights[:-1]) / 2
        if risk < best[0]:
            best = (risk, model)
        hess = np.zeros((k + 1, k + 1))
        for (i, j), v in zip(upper, sums[5 + 3 * (k + 1):]):
            hess[i, j] = hess[j, i] = v / n
        keep = np.append(np.full(k, ridge), 0.0) * model.weights
        of_negative = u / n - prior * pm / n_p
        gradient = (of_negative - prior * pp / n_p if negative >= 0 else -of_negative) + keep
        step = np.linalg.solve(hess + np.diag(np.append(np.full(k, ridge), 1e-6)), gradient)
        step *= min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-4:
            break
        model = Linear(mean, scale, model.weights - step)
    return best[1] or model


def class_prior(rows: DataFrame, model: Linear, bins: int = BINS) -> float:
    """Share of positives among all rows: the least ratio of the two tails over score bins, with its error margin."""
    by_bin = rows.groupBy(F.floor(F.least(model.score(), F.lit(1 - 1e-9)) * bins).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.when(F.col("_trusted"), 1).otherwise(0)).alias("_t"))
    found = sorted(((r[0], r[1], r[2]) for r in by_bin.collect()), reverse=True)  # at most `bins` rows
    n, n_p = sum(r[1] for r in found), sum(r[2] for r in found)
    if not n_p:
        return 0.5
    error = math.sqrt(math.log(40) / 2 / n) + math.sqrt(math.log(40) / 2 / n_p)
    least, ratio, a, b = math.inf, 1.0, 0, 0
    for _, rows_here, trusted in found:
        a, b = a + rows_here, b + trusted
        if b:
            bound = (a / n + error) / (b / n_p)
            if bound < least:
                least, ratio = bound, a / n / (b / n_p)
    return min(max(ratio, 0.02), 0.98)


def pu_quality(docs: DataFrame, trusted: DataFrame, steps: int = STEPS) -> DataFrame:
    """One row a document: `doc_id`, `score` (0 to 1, higher: good quality likelier), `margin`, `prior`.

    `trusted` holds the `doc_id` of positives; all rows of `docs` are the unlabelled text. A first fit at an even
    prior ranks rows, the class prior is read off the two score distributions, and the final fit minimises the
    non-negative unbiased risk at that prior. Every sum runs over all rows; only sums reach the driver.

    Null or empty texts are scored by their zero features, a null `doc_id` is never trusted, repeated rows of
    either table get a row each (documents) or count once (trusted), no rows give no rows, no trusted row gives
    0.5 to all. Other columns are ignored.
    """
    python_ready(docs.sparkSession)
    marks = trusted.select(F.col("doc_id").cast("long")).where(F.col("doc_id").isNotNull()).distinct()
    marked = featured(docs).join(marks.withColumn("_trusted", F.lit(True)), "doc_id", "left")
    rows = staged(marked.withColumn("_trusted", F.coalesce("_trusted", F.lit(False))))
    first = fitted(rows, 0.5, steps)
    prior = class_prior(rows, first)
    model = fitted(rows, prior, steps)
    return rows.select("doc_id", model.score().alias("score"), model.margin().alias("margin"), F.lit(prior).alias("prior"))
