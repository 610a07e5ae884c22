"""Feeds and sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions.dates import parse_date_es, parse_published
from kermesse.functions.money import parse_price_clp
from kermesse.functions.places import detect_area
from kermesse.functions.text import strip_html, summarise, unescape
from kermesse.operators.columns import compute_once
from kermesse.operators.skew import top_k
from kermesse.sources.captures import as_candidates, order_number


def element(xml: Column, name: str) -> Column:
    """Text of the first ``<name>`` child, CDATA unwrapped."""
    raw = F.regexp_extract(xml, rf"(?s)<(?:\w+:)?{name}\b[^>]*>(.*?)</(?:\w+:)?{name}>", 1)
    return F.trim(F.regexp_replace(raw, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1"))


def blocks(captures: DataFrame, name: str) -> DataFrame:
    """One row per ``<name>`` element of each body."""
    return captures.select("source_id", "url", F.col("seq").alias("captura"), F.posexplode(F.regexp_extract_all(
        F.col("body"), F.lit(rf"(?s)<(?:\w+:)?{name}\b[^>]*>.*?</(?:\w+:)?{name}>"), 0)).alias("pos", "xml"))


def extract_feed_items(captures: DataFrame, source: str, as_of: Column, area: str = "",
                       limit: int | None = None) -> DataFrame:
    """Items of each feed that name a date; ``limit`` keeps the first ones only."""
    rows = blocks(captures, "item")
    rows = rows if limit is None else rows.filter(F.col("pos") < limit)
    x = F.col("xml")
    rows = compute_once(rows, titulo=strip_html(unescape(element(x, "title"))), fuente_url=element(x, "link"),
                        d=strip_html(unescape(element(x, "description"))))
    rows = rows.filter("titulo != '' and fuente_url != ''").withColumn("t", F.concat_ws(". ", "titulo", "d"))
    rows = compute_once(rows, inicio=parse_date_es(F.col("t"), as_of), p=parse_price_clp(F.col("t")))
    return as_candidates(rows.filter("inicio is not null").select(
        order_number(F.col("captura"), F.col("pos")).alias("seq"), "titulo",
        summarise(F.col("d")).alias("descripcion_corta"), "inicio", F.lit(source).alias("lugar_nombre"),
        detect_area(F.col("t"), F.lit(area)).alias("comuna"), F.col("p.price").alias("precio_clp"),
        F.col("p.free").alias("es_gratis"), F.col("p.note").alias("precio_texto"),
        F.lit("rss").alias("fuente_tipo"), F.lit(source).alias("fuente_nombre"), "fuente_url"))


def extract_sitemap_entries(captures: DataFrame, as_of: Column, url_part: str = "", origin: str = "sitemap",
                            limit: int | None = None) -> DataFrame:
    """source_id, entry_url, mark, publicado of every entry; ``limit`` keeps each source's newest ones.

    ``origin``: ``sitemap`` or ``rss``; a page listing goes through ``extract_links``.
    """
    tag, link, date = {"sitemap": ("url", "loc", "lastmod"), "rss": ("item", "link", "pubDate")}[origin]
    rows = blocks(captures, tag).select(
        "source_id", order_number(F.col("captura"), F.col("pos")).alias("seq"),
        element(F.col("xml"), link).alias("entry_url"), element(F.col("xml"), date).alias("mark"))
    rows = rows.filter(F.col("entry_url") != "")
    if url_part:
        rows = rows.filter(F.contains("entry_url", F.lit(url_part)))
    dated = rows.withColumn("publicado", parse_published(F.col("mark"), as_of))
    return dated if limit is None else top_k(dated, ["source_id"], [F.col("publicado").desc_nulls_last(), F.col("seq")], limit)
