"""The raw-capture table and the steps shared by every source kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions.dates import parse_date_es
from kermesse.functions.money import parse_price_clp
from kermesse.functions.text import strip_html
from kermesse.operators.filters import keyword_reason
from kermesse.operators.skew import lookup, lookup_settings, top_k
from kermesse.schemas import CANDIDATE, SOURCE_KINDS, conform

#: Bits of an input order number: of the session, and of the two levels of position. A capture has the rest.
SESSION_BITS, LEVEL_BITS = 10, 13


def read_captures(spark, path: str, fmt: str = "parquet", day: str | None = None) -> DataFrame:
    """Captured responses; ``day`` prunes the ``fetch_date`` partitions."""
    df = spark.read.format(fmt).load(path)
    return df.filter(F.col("fetch_date") == day) if day else df


def scan_captures(captures: DataFrame, kind: str) -> DataFrame:
    """Usable responses of one source kind."""
    return captures.filter((F.col("kind") == kind) & F.col("status").between(200, 299))


def unknown_kinds(captures: DataFrame, known=SOURCE_KINDS) -> DataFrame:
    """One error row per source whose kind nobody reads."""
    odd = captures.filter(~F.coalesce("kind", F.lit("")).isin(*known))
    return odd.groupBy("source_id", "kind").agg(F.count(F.lit(1)).alias("capturas")).withColumn(
        "error", F.concat(F.lit("tipo_adaptador desconocido: "), F.coalesce("kind", F.lit(""))))


def order_number(capture: Column, position: Column, session: Column | None = None) -> Column:
    """Input order of a row: capture, then item (see ``nested`` for two levels), then session."""
    base = capture.cast("bigint") * (1 << 2 * LEVEL_BITS) + position.cast("bigint")
    return base * (1 << SESSION_BITS) + (F.lit(0) if session is None else session.cast("bigint"))


def nested(outer: Column, inner: Column) -> Column:
    """Position of an item inside a block of a capture."""
    return outer.cast("bigint") * (1 << LEVEL_BITS) + inner.cast("bigint")


def as_candidates(rows: DataFrame) -> DataFrame:
    return conform(rows, CANDIDATE)


def source_tier_fallback(rows: DataFrame) -> DataFrame:
    """Keep each source's best ``tier`` (the smallest that brought rows)."""
    best = rows.groupBy("source_id").agg(F.min("tier").alias("_best"))
    return lookup(rows, best, ["source_id"]).filter(F.col("tier") == F.col("_best")).drop("_best")


def union_term_searches(rows: DataFrame) -> DataFrame:
    """Result sets of several search words as one, without repeated items."""
    return rows.groupBy("endpoint", "id_externo").agg(
        F.min(F.struct("seq", F.struct(*rows.columns).alias("row")))["row"].alias("row")).select("row.*")


def meta_content(html: Column, name: str) -> Column:
    """``content`` of a ``<meta property=...>`` element."""
    tag = F.regexp_extract(html, rf"(?is)<meta[^>]*property=[\"']{name}[\"'][^>]*>", 0)
    return strip_html(F.regexp_extract(tag, r"(?is)content=[\"']([^\"']*)[\"']", 1))


def visible_text(html: Column) -> Column:
    """Text of a page without navigation, header, footer, scripts and styles."""
    bare = html
    for tag in ("script", "style", "nav", "header", "footer"):
        bare = F.regexp_replace(bare, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    return strip_html(F.regexp_replace(bare, r"(?s)<!--.*?-->", " "))


def backfill_from_detail(rows: DataFrame, details: DataFrame, config: DataFrame, as_of: Column) -> DataFrame:
    """Date and price of undated rows from their detail page, within each source's budget.

    ``details``: url, body. ``config``: source_id, tope_detalle, filtro_palabras,
    descartar_palabras. Only rows that pass the word lists spend budget; no ``tope_detalle`` is no budget.
    """
    flagged = lookup_settings(rows.filter(F.col("inicio").isNull()), config, ["source_id"])
    wanted = flagged.filter(keyword_reason(
        F.col("filtro_palabras"), F.col("descartar_palabras")).isNull())
    budget = top_k(wanted, ["source_id"], [F.col("seq")], F.coalesce("tope_detalle", F.lit(2_147_483_647)))
    pages = details.groupBy("url").agg(F.min("body").alias("body"))
    opened = budget.select("seq", F.col("fuente_url").alias("url"), "fecha_publicacion").join(pages, "url")
    text = visible_text(F.col("body"))
    facts = opened.select("seq", parse_date_es(text, as_of, F.col("fecha_publicacion")).alias("_d"),
                          parse_price_clp(text).alias("_p"), meta_content(F.col("body"), "og:image").alias("_i"))
    out = rows.join(facts, "seq", "left")
    unknown = F.col("precio_clp").isNull() & F.col("es_gratis").isNull() & F.col("_d").isNotNull()
    blank = F.coalesce("imagen_url", F.lit("")) == ""
    return out.withColumns({
        "inicio": F.coalesce("inicio", "_d"),
        "precio_clp": F.when(unknown, F.col("_p.price")).otherwise(F.col("precio_clp")),
        "es_gratis": F.when(unknown, F.col("_p.free")).otherwise(F.col("es_gratis")),
        "precio_texto": F.when(unknown, F.col("_p.note")).otherwise(F.col("precio_texto")),
        "imagen_url": F.when(blank & F.col("_i").startswith("http"), F.col("_i")).otherwise(F.col("imagen_url")),
    }).select(*rows.columns)
