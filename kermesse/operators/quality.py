"""Blocking expectations: ``(level, check, key, detail)`` rows; no error row means publishable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions.places import in_bbox
from kermesse.functions.text import fold_text, mentions_any
from kermesse.vocab.labels import CATEGORIES, SCALES
from kermesse.vocab.offers import DAY_IN_TEXT
from kermesse.vocab.places import BOX_CATALOGUE, OUTSIDE_CITIES, PRECISIONS

# Floors and thresholds of the gate.
MIN_EVENTS, MIN_WORKSHOPS, MIN_OFFERS = 100, 200, 100
MIN_PIN_SHARE, MAX_DROP, FRESH_HOURS = 0.6, 0.5, 24


def _rows(df: DataFrame, check: str, key: Column, problems: list[Column]) -> DataFrame:
    """One output row per problem struct(level, detail) of each input row."""
    return df.select(key.cast("string").alias("key"), F.explode_outer(F.array_compact(F.array(*problems))).alias("p")
                     ).filter("p is not null").select("p.level", F.lit(check).alias("check"), "key", "p.detail")


def _when(cond: Column, detail: str, level: str = "error") -> Column:
    return F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(detail).alias("detail")))


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) == ""


def check_events(events: DataFrame) -> DataFrame:
    """Required fields, whole and plausible coordinates, known labels, end after start, unique ids."""
    half = F.col("lat").isNull() != F.col("lon").isNull()
    outside = F.col("lat").isNotNull() & ~in_bbox(F.col("lat"), F.col("lon"), BOX_CATALOGUE)
    bad_start = ~_blank("inicio") & F.col("inicio").cast("string").try_cast("timestamp").isNull()
    rows = _rows(events, "evento", F.col("id"), [
        _when(_blank("id"), "sin id"), _when(_blank("titulo"), "sin titulo"), _when(_blank("url"), "sin url"),
        _when(bad_start, "inicio no es fecha"), _when(half, "lat/lon a medias"),
        _when(outside, "coordenadas fuera"),
        _when(~F.coalesce("categoria", F.lit("?")).isin(*CATEGORIES), "categoria desconocida", "aviso"),
        _when(~F.coalesce("precision", F.lit("?")).isin(*PRECISIONS), "precision desconocida", "aviso"),
        _when(~F.coalesce("escala", F.lit("")).isin(*SCALES), "escala desconocida"),
        _when(F.coalesce(F.col("fin") < F.col("inicio"), F.lit(False)), "fin anterior al inicio")])
    return rows.unionByName(check_unique(events))


def check_unique(df: DataFrame, check: str = "id") -> DataFrame:
    dup = df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and id is not null")
    return dup.select(F.lit("error").alias("level"), F.lit(check).alias("check"),
                      F.col("id").cast("string").alias("key"),
                      F.concat(F.lit("id duplicado x"), F.col("n").cast("string")).alias("detail"))


def check_volume(events: DataFrame, floor: int, name: str, generated: Column | None = None,
                 now: Column | None = None, pin_share: float | None = MIN_PIN_SHARE) -> DataFrame:
    """Volume floor, freshness and the share of rows with a pin."""
    agg = events.agg(F.count(F.lit(1)).alias("n"), F.count("lat").alias("pins"))
    problems = [_when(F.col("n") < floor, f"menos de {floor} filas")]
    if generated is not None and now is not None:
        age = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(generated.cast("timestamp"))
        problems.append(_when(F.coalesce(age > FRESH_HOURS * 3600, F.lit(True)), "no es de hoy"))
    if pin_share is not None:
        problems.append(_when((F.col("n") > 0) & (F.col("pins") < F.col("n") * pin_share), "pocos pines"))
    return _rows(agg, "volumen", F.lit(name), problems)


def check_drop(before: DataFrame, after: DataFrame, force: bool = False) -> DataFrame:
    """Blocks when both catalogues together fell below half of the previous total."""
    a = before.agg(F.count(F.lit(1)).alias("antes")).withColumn("k", F.lit(1))
    b = after.agg(F.count(F.lit(1)).alias("ahora")).withColumn("k", F.lit(1))
    fell = (F.col("antes") > 0) & (F.col("ahora") < F.col("antes") * MAX_DROP)
    return _rows(a.join(b, "k"), "caida", F.lit("catalogo"), [
        _when(fell, "cayo a menos de la mitad", "aviso" if force else "error")])


def check_workshops(shops: DataFrame) -> DataFrame:
    """Weekdays within 0..6; seasons without days are counted in one warning."""
    days = F.coalesce("dias_semana", F.array().cast("array<int>"))
    rows = _rows(shops, "taller", F.col("id"), [
        _when(_blank("id") | _blank("titulo"), "sin id o sin titulo"),
        _when(F.exists(days, lambda d: (d < 0) | (d > 6)), "dias fuera de 0..6"),
        _when(F.coalesce(F.col("fin") < F.col("inicio"), F.lit(False)), "fin anterior al inicio")])
    seasons = shops.agg(F.count_if((F.size(days) == 0) & F.col("fin").isNotNull()).alias("n")).filter("n > 0")
    return rows.unionByName(check_unique(shops)).unionByName(seasons.select(
        F.lit("aviso").alias("level"), F.lit("taller").alias("check"), F.lit("temporadas").alias("key"),
        F.concat(F.col("n").cast("string"), F.lit(" sin dias")).alias("detail")))


def check_offers(offers: DataFrame) -> DataFrame:
    """A text that names a day must not leave the day list empty."""
    said = F.concat_ws(" ", F.col("condiciones"), F.col("oferta")).rlike(DAY_IN_TEXT)
    half = F.col("lat").isNull() != F.col("lon").isNull()
    return _rows(offers, "oferta", F.col("id"), [
        _when(F.col("dias").isNull(), "dias no es lista"),
        _when((F.size("dias") == 0) & said, "dice un dia y quedo sin dias"),
        _when(_blank("comercio"), "sin comercio"), _when(_blank("banco"), "sin banco"),
        _when(_blank("id"), "sin id"), _when(half, "lat/lon a medias")])


def missing_cards(published: DataFrame, cards: DataFrame) -> DataFrame:
    """Published ids without their share card."""
    return published.join(cards.select("id").distinct(), "id", "left_anti").select(
        F.lit("error").alias("level"), F.lit("ficha").alias("check"), F.col("id").cast("string").alias("key"),
        F.lit("sin ficha").alias("detail"))


def unnamed_subcategories(published: DataFrame, known: DataFrame) -> DataFrame:
    """Second-level labels nobody has given a display name."""
    used = published.filter(F.coalesce("subcategoria", F.lit("")) != "").groupBy("subcategoria").agg(
        F.count(F.lit(1)).alias("n"))
    return used.join(known.select("subcategoria"), "subcategoria", "left_anti").select(
        F.lit("aviso").alias("level"), F.lit("subcategoria").alias("check"), F.col("subcategoria").alias("key"),
        F.concat(F.col("n").cast("string"), F.lit(" sin nombre")).alias("detail"))


def contamination(published: DataFrame) -> DataFrame:
    """Titles that name a city of another region under an area of this one."""
    hit = mentions_any(fold_text(F.col("titulo"), "collapse"), OUTSIDE_CITIES)
    return _rows(published.filter(F.coalesce("comuna", F.lit("")) != ""), "contaminacion", F.col("id"),
                 [_when(hit, "el titulo nombra otra ciudad")])


def publishable(expectations: DataFrame) -> DataFrame:
    """One row: whether the gate lets the catalogue through."""
    return expectations.agg((F.count_if(F.col("level") == "error") == 0).alias("publicable"),
                            F.count_if(F.col("level") == "error").alias("errores"),
                            F.count_if(F.col("level") == "aviso").alias("avisos"))
