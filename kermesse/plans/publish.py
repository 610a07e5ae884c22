"""From the store to the published catalogue: labels, corrections, pins, series, formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions import labels
from kermesse.functions.text import is_machine_url, venue_from_title
from kermesse.operators.collapse import collapse_weekly_series, degrade_shared_pins
from kermesse.operators.corrections import overlay_event_corrections, overlay_place_corrections
from kermesse.operators.filters import is_current
from kermesse.operators.geocode import Catalogue, geocode, override_contradicting_coords
from kermesse.operators.store import split_formats
from kermesse.session import stage


def labelled(store: DataFrame, as_of: Column, use_hour: bool = True) -> DataFrame:
    """Published shape of the current rows with their five labels, before corrections."""
    c = F.col
    rows = store.filter(is_current(c("inicio"), c("fin"), as_of) & (c("estado") != "descartado"))
    rows = rows.filter(labels.drop_reason(c("titulo"), c("descripcion_corta")).isNull() & ~is_machine_url(c("fuente_url")))
    args = (c("lugar_nombre"), c("fuente_nombre"))
    rows = rows.withColumn("_cat", labels.classify_category(c("titulo"), c("categoria"), c("descripcion_corta"), *args))
    venue = venue_from_title(c("titulo"), F.coalesce("lugar_nombre", F.lit("")))
    place = F.coalesce(*[F.when(F.coalesce(p, F.lit("")) != "", p) for p in (venue, c("lugar_nombre"), c("fuente_nombre"))])
    return rows.select(
        c("hash_dedup").alias("id"), c("hash_dedup").alias("seq"), "titulo", "inicio", "fin", place.alias("lugar"),
        F.coalesce("lugar_direccion", F.lit("")).alias("direccion"), F.coalesce("comuna", F.lit("")).alias("comuna"), "lat", "lon",
        F.when(c("lat").isNotNull(), "fuente").otherwise("").alias("precision"),
        F.coalesce("es_gratis", F.lit(False)).alias("gratis"), c("precio_clp").alias("precio"),
        F.coalesce("precio_texto", F.lit("")).alias("precio_texto"), c("_cat.label").alias("categoria"),
        labels.classify_subcategory(c("_cat.label"), c("titulo"), c("categoria"), c("descripcion_corta"), *args)["label"].alias("subcategoria"),
        labels.classify_scale(c("titulo"), *args, c("precio_clp"), c("descripcion_corta"))["label"].alias("escala"),
        labels.classify_audience(c("titulo"), c("descripcion_corta"), c("_cat.label"), *args,
                                 F.hour("inicio") if use_hour else None)["label"].alias("publico"),
        F.coalesce("descripcion_corta", F.lit("")).alias("descripcion"), F.coalesce("imagen_url", F.lit("")).alias("imagen"),
        c("fuente_nombre").alias("fuente"), c("fuente_url").alias("url"), c("_cat.reason").alias("origen"))


def publish(store: DataFrame, as_of: Column, catalogue: Catalogue,
            place_fixes: DataFrame | None = None, event_fixes: DataFrame | None = None,
            prior: DataFrame | None = None) -> DataFrame:
    """The whole catalogue with ``formato``; filter on it for the two published lists.

    Corrections come before geocoding, series before the shared-pin check, formats last.
    Steps that branch are written out once each.
    """
    rows = labelled(store, as_of).withColumn("tocados", F.array().cast("array<string>"))
    if place_fixes is not None:
        rows = overlay_place_corrections(rows, place_fixes)
    if event_fixes is not None:
        rows = overlay_event_corrections(rows, event_fixes)
    rows = stage(override_contradicting_coords(stage(rows), catalogue.spans))
    rows = stage(geocode(rows, catalogue, prior))
    return split_formats(degrade_shared_pins(collapse_weekly_series(rows)))
