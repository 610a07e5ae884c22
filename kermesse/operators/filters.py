"""Row predicates and the filters built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions import labels
from kermesse.functions.cards import has_hour
from kermesse.functions.dates import window_bounds
from kermesse.functions.places import planar_km
from kermesse.functions.text import (fold_text, is_machine_url, is_public_url, mentioned_word)
from kermesse.operators.skew import lookup, lookup_settings
from kermesse.vocab.places import NOT_A_PLACE


def ended_before(start: Column, end: Column, as_of: Column) -> Column:
    """Over before today; an end earlier than its start is ignored."""
    last = F.when(end >= start, end).otherwise(start)
    return F.coalesce(last.cast("date") < as_of.cast("date"), F.lit(False))


def reject_reason(as_of: Column) -> Column:
    """First reason to refuse a candidate, or NULL when it is valid."""
    title, url = F.col("titulo"), F.coalesce(F.col("fuente_url"), F.lit(""))
    return (F.when(F.length(F.trim(F.coalesce(title, F.lit("")))) < 3, "sin titulo")
            .when(url == "", "sin link a la fuente")
            .when(~is_public_url(url), "el link no es http(s)")
            .when(is_machine_url(url), "el link es un endpoint")
            .when(ended_before(F.col("inicio"), F.col("fin"), as_of), "evento pasado"))


def validate(df: DataFrame, as_of: Column) -> DataFrame:
    """Adds ``motivo``; NULL means accepted."""
    return df.withColumn("motivo", reject_reason(as_of))


def keyword_reason(include: Column, exclude: Column) -> Column:
    """Why the word lists of a source drop a row; exclusion is looked at first."""
    text = fold_text(F.concat_ws(" ", *[F.when(F.col(c) != "", F.col(c)) for c in (
        "titulo", "descripcion_corta", "categoria")]))
    banned = mentioned_word(text, exclude)
    wanted = mentioned_word(text, include)
    return (F.when(banned.isNotNull(), F.concat(F.lit("palabra excluida: "), banned))
            .when((F.coalesce(F.size(include), F.lit(0)) > 0) & wanted.isNull(),
                  F.lit("no menciona ninguna palabra del filtro")))


def gate(df: DataFrame, config: DataFrame, as_of: Column) -> DataFrame:
    """Validity, required area and word lists in order, as one ``motivo`` per row.

    ``config`` has one row per source: fuente_nombre, requiere_comuna, filtro_palabras,
    descartar_palabras.
    """
    joined = lookup_settings(df, config.select("fuente_nombre", "requiere_comuna", "filtro_palabras",
                                               "descartar_palabras"), ["fuente_nombre"])
    no_area = F.coalesce(F.col("requiere_comuna"), F.lit(False)) & (
        F.coalesce(F.col("comuna"), F.lit("")) == "")
    motivo = F.coalesce(reject_reason(as_of), F.when(no_area, F.lit("sin comuna")),
                        keyword_reason(F.col("filtro_palabras"), F.col("descartar_palabras")))
    return joined.withColumn("motivo", motivo).drop(
        "requiere_comuna", "filtro_palabras", "descartar_palabras")


def is_current(start: Column, end: Column, as_of: Column, keep_undated: bool = False) -> Column:
    """Still on today. The published page keeps undated rows, the store does not."""
    day = F.coalesce(end, start).cast("date")
    return F.coalesce(day >= as_of.cast("date"), F.lit(keep_undated))


def drop_non_events(df: DataFrame) -> DataFrame:
    return df.filter(labels.drop_reason(F.col("titulo"), F.col("descripcion_corta")).isNull())


def offer_alive(expiry: Column, as_of: Column) -> Column:
    return expiry.isNull() | (expiry >= as_of.cast("date"))


def exclude_merchants(offers: DataFrame, excluded: DataFrame) -> DataFrame:
    """Drop blank merchants and the per-bank exclusion list (banco_id, comercio)."""
    key = F.lower(F.trim(F.col("comercio")))
    listed = excluded.select("banco_id", key.alias("_k")).distinct().withColumn("_out", F.lit(True))
    named = offers.filter(F.coalesce(F.col("comercio"), F.lit("")) != "").withColumn("_k", key)
    return lookup(named, listed, ["banco_id", "_k"]).filter("_out is null").select(*offers.columns)


def null_half_coordinate(df: DataFrame) -> DataFrame:
    whole = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return df.withColumns({"lat": F.when(whole, F.col("lat")), "lon": F.when(whole, F.col("lon"))})


def search_all_words(query: str, *fields: Column) -> Column:
    """Every word of the query occurs somewhere in the folded fields."""
    from kermesse.functions.text import fold_py
    hay = fold_text(F.concat_ws(" ", *[F.coalesce(f, F.lit("")) for f in fields]))
    out = F.lit(True)
    for word in fold_py(query).split():
        out = out & F.contains(hay, F.lit(word))
    return out


def in_date_window(window: str, start: Column, end: Column, weekdays: Column, as_of: Column) -> Column:
    """Point, weekly series and running season each ask the window their own way."""
    if window == "todo":
        return F.lit(True)
    lo, hi = window_bounds(window, as_of)
    day0, dayn = start.cast("date"), F.coalesce(end, start).cast("date")
    ref = as_of.cast("date")
    series = F.coalesce(F.size(weekdays), F.lit(0)) > 0
    first = F.greatest(lo, day0, ref)
    # Any seven days hold every weekday, so a longer window needs no longer walk.
    last = F.least(hi, dayn)
    session = F.when(first <= last, F.exists(
        F.sequence(first, F.least(last, F.date_add(first, 6))), lambda d: F.array_contains(weekdays, F.weekday(d))))
    season = F.coalesce(end > start, F.lit(False)) & (day0 <= hi) & (dayn >= lo)
    point = (day0 >= lo) & (day0 <= hi)
    return F.when(series, F.coalesce(session, F.lit(False))).when(
        F.coalesce(end > start, F.lit(False)), season).otherwise(F.coalesce(point, F.lit(False)))


def time_band(start: Column, band: str) -> Column:
    """``manana`` before 12, ``tarde`` to 18, ``noche`` after; an unknown hour passes."""
    h = F.hour(start)
    inside = {"manana": h < 12, "tarde": (h >= 12) & (h < 18), "noche": h >= 18}[band]
    return ~has_hour(start) | inside


def price_cap(free: Column, price: Column, cap: int) -> Column:
    return F.coalesce(free, F.lit(False)) | F.coalesce(price <= cap, F.lit(False))


def audience_inclusive(audience: Column, wanted: str) -> Column:
    who = F.coalesce(audience, F.lit("todos"))
    return {"ninos": who.isin("ninos", "todos"), "adolescentes": ~who.isin("ninos", "adultos"),
            "adultos": who == "adultos"}[wanted]


def within_radius(lat: Column, lon: Column, precision: Column, centre: tuple[float, float],
                  km: float) -> Column:
    """Near an exact pin; approximate or missing pins never are."""
    near = planar_km(lat, lon, F.lit(centre[0]), F.lit(centre[1])) <= km
    exact = ~F.coalesce(precision, F.lit("")).isin("comuna", "sin_ubicar")
    return F.coalesce(near & exact, F.lit(False))


def is_real_place(name: Column) -> Column:
    return ~F.coalesce(name, F.lit("")).rlike("(?iu)" + NOT_A_PLACE)
