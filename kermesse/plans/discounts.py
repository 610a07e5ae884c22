"""The offers run: alive and local offers, one per merchant and area, with a pin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions.offers import in_region
from kermesse.operators.corrections import overlay_merchant_corrections
from kermesse.operators.filters import exclude_merchants, offer_alive
from kermesse.operators.geocode import Catalogue, geocode
from kermesse.session import stage
from kermesse.operators.offers import dedup_keep_richest, lend_addresses, with_id


def collect(offers: DataFrame, as_of: Column, excluded: DataFrame | None = None) -> DataFrame:
    """Alive, named, in-region offers, the richest per key."""
    rows = offers.filter(offer_alive(F.col("vigencia_hasta"), as_of) & (F.coalesce("comercio", F.lit("")) != ""))
    if excluded is not None:
        rows = exclude_merchants(rows, excluded)
    return dedup_keep_richest(with_id(rows.filter(in_region(F.col("comuna"), F.col("region")))))


def locate(offers: DataFrame, catalogue: Catalogue, fixes: DataFrame | None = None) -> DataFrame:
    """Corrections, lent addresses, then the geocoding tiers for rows still without a pin."""
    rows = stage(offers)
    if fixes is not None:
        rows = overlay_merchant_corrections(rows, fixes).drop("tocados")
    rows = lend_addresses(rows)
    rows = rows.withColumn("precision", F.when(F.col("precision") == "correccion", F.col("precision"))
                           .when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), "fuente")
                           .otherwise(F.coalesce("precision", F.lit("")))).withColumn("lugar", F.lit(""))
    return geocode(stage(rows), catalogue).drop("lugar")
