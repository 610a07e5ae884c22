"""Costly columns computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read without computing them again.

    A plain projection is merged into whatever reads it, and a filter on it is pushed below
    it, so a long parsing expression would run once per reference. A one-row generator is a
    step the optimizer keeps in place.
    """
    packed = F.explode_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    kept = [c for c in df.columns if c not in columns]
    return df.select("*", packed.alias("_once")).select(*kept, *[F.col(f"_once.{n}").alias(n) for n in columns])
