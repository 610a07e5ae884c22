"""Facets, blocking filters and map pins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_failed(df: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """Adds ``fallan``: the names of the filters each row does not pass."""
    return df.withColumn("fallan", F.array_compact(F.array(*[
        F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in filters.items()])))


def facet_counts(df: DataFrame, filters: dict[str, Column], options: dict[str, Column]) -> DataFrame:
    """Rows per facet option with every *other* filter applied, in one pass.

    ``options`` gives the array of options a row belongs to in each facet.
    """
    marked = with_failed(df, filters)

    def labelled(name: str, opts: Column) -> Column:
        pairs = F.transform(opts, lambda o: F.struct(F.lit(name).alias("faceta"), o.cast("string").alias("opcion")))
        return F.when(F.size(F.array_remove("fallan", name)) == 0, pairs).otherwise(
            F.array().cast("array<struct<faceta:string,opcion:string>>"))

    choices = F.flatten(F.array(*[labelled(name, opts) for name, opts in options.items()]))
    return (marked.select(F.explode_outer(choices).alias("c")).filter("c is not null").groupBy("c.faceta", "c.opcion")
            .agg(F.count(F.lit(1)).alias("n")))


def blocking_filter(df: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """How many rows removing each active filter alone would leave, best first."""
    marked = with_failed(df, filters).filter(F.size("fallan") <= 1)
    counts = marked.groupBy(F.get("fallan", F.lit(0)).alias("filtro")).agg(F.count(F.lit(1)).alias("n"))
    passing = counts.filter("filtro is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pasan")).withColumn("k", F.lit(1))
    names = passing.withColumn("filtro", F.explode(F.array(*[F.lit(f) for f in filters])))
    return names.join(counts.filter("filtro is not null"), "filtro", "left").select(
        "filtro", (F.col("pasan") + F.coalesce("n", F.lit(0))).alias("n")).orderBy(F.desc("n"), "filtro")


def cluster_approx_pins(published: DataFrame) -> DataFrame:
    """Exact pins one by one; area pins as one counted row per area."""
    pinned = published.filter(F.col("lat").isNotNull())
    exact = pinned.filter(F.coalesce("precision", F.lit("")) != "comuna").select(
        "id", "comuna", "lat", "lon", F.lit(1).cast("bigint").alias("eventos"), F.lit(False).alias("aproximado"))
    area = F.when(F.coalesce("comuna", F.lit("")) != "", F.col("comuna")).otherwise(
        F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")))
    approx = (pinned.filter(F.col("precision") == "comuna").groupBy(area.alias("_a"))
              .agg(F.min(F.struct("seq", "lat", "lon")).alias("p"), F.min("comuna").alias("comuna"),
                   F.count(F.lit(1)).alias("eventos"))
              .select(F.lit(None).cast(published.schema["id"].dataType).alias("id"), "comuna", "p.lat", "p.lon",
                      "eventos", F.lit(True).alias("aproximado")))
    return exact.unionByName(approx)
