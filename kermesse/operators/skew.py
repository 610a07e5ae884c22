"""Grouping and lookup helpers that stay even when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kermesse.session import stage


def lookup(big: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``big`` to ``dim`` (one row per key).

    The looked-up side is shuffled once, whatever its size. Adaptive execution splits the partitions of a hot key at
    run time and copies only that key's row, and turns the join into a broadcast when ``dim`` proves small.
    """
    return big.join(dim, list(on), how)


#: Settings up to this many characters as JSON go to every task whole.
SETTINGS_CHARS = 8_000_000


def lookup_settings(big: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join ``big`` to ``dim``, one row of settings per source (or another key with few values).

    Few keys make few partitions: shuffled by them, rows would pile up in as many tasks as there are sources. So ``dim``
    is written and measured, and where it is small ``big`` stays where it lies. A larger one is looked up by a shuffle.
    """
    dim = stage(dim)
    size = dim.agg(F.sum(F.length(F.to_json(F.struct(*dim.columns))).cast("bigint"))).first()[0] or 0
    return lookup(big, F.broadcast(dim) if size <= SETTINGS_CHARS else dim, on)


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], largest: bool = False) -> DataFrame:
    """One row per key, the first (or last) in ``order``; pre-aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    pick = (F.max if largest else F.min)(F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("_row")))
    return df.groupBy(*keys).agg(pick.alias("_best")).select(*keys, "_best._row.*").select(*df.columns)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int | Column,
          rank_name: str | None = None, salts: int = 64) -> DataFrame:
    """First ``k`` rows per key.

    For a literal ``k`` Spark limits each task's groups before the shuffle. For a per-row
    ``k`` a first pass ranks within hashed slices of the key and the second only sees what
    those slices kept; both give the exact rows.
    """
    name = rank_name or "_rank"
    rank = lambda extra: F.row_number().over(Window.partitionBy(*keys, *extra).orderBy(*order))
    if isinstance(k, Column):
        cols = df.columns
        df = df.withColumn("_slice", F.pmod(F.xxhash64(*order_free(cols, df)), F.lit(salts)))
        df = df.withColumn("_pre", rank(["_slice"])).filter(F.col("_pre") <= k).select(*cols)
    out = df.withColumn(name, rank([])).filter(F.col(name) <= k)
    return out if rank_name else out.drop(name)


def order_free(cols: Sequence[str], df: DataFrame) -> list[str]:
    """Columns a hash can read: everything but maps and variants."""
    kinds = dict(df.dtypes)
    return [c for c in cols if not any(t in kinds[c] for t in ("map<", "variant"))]
