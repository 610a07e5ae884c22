"""JSON sources: mapped APIs, CMS posts, ticket listings. Bodies are read as VARIANT."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions import dates
from kermesse.functions.money import parse_price_clp, pesos
from kermesse.functions.places import detect_area
from kermesse.functions.text import is_machine_url, squeeze, strip_html, summarise
from kermesse.operators.columns import compute_once
from kermesse.sources.captures import as_candidates, order_number

LOCAL_ZONE = "America/Santiago"


def _json_path(path: str) -> str:
    return "$" + "".join(f"['{p}']" for p in path.split("."))


def values(v: Column, path: str) -> Column:
    """All values of a dotted path as ``array<variant>``; lists on the way are flattened."""
    head, _, rest = path.partition("[]")
    rest = rest.lstrip(".")
    here = F.try_variant_get(v, _json_path(head), "array<variant>") if head else \
        F.try_variant_get(v, "$", "array<variant>")
    one = F.try_variant_get(v, _json_path(head), "variant")
    listed = F.coalesce(here, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<variant>"))
    return F.flatten(F.transform(listed, lambda x: values(x, rest))) if rest else listed


def text_at(v: Column, path: str) -> Column:
    """First scalar of a path as clean text, blank when absent."""
    if not path:
        return F.lit("")
    return strip_html(raw_at(v, path))


def raw_at(v: Column, path: str) -> Column:
    """First scalar of a path as raw text, NULL when absent."""
    if "[]" in path:
        return F.try_variant_get(F.get(values(v, path), F.lit(0)), "$", "string")
    p = _json_path(path)
    return F.coalesce(F.get(F.try_variant_get(v, p, "array<string>"), F.lit(0)),
                      F.try_variant_get(v, p, "string"))


def is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT")


def items(captures: DataFrame, list_path: str = "") -> DataFrame:
    """One row per object of the list inside each page; pages of an endpoint become one list."""
    body = F.try_parse_json(F.col("body"))
    listed = F.try_variant_get(body, _json_path(list_path) if list_path else "$", "array<variant>")
    rows = captures.select("source_id", "url", F.col("seq").alias("captura"),
                           F.posexplode(listed).alias("pos", "item"))
    return rows.filter(is_object(F.col("item")))


@dataclass(frozen=True)
class JsonMapping:
    """How one JSON source is read; paths are dotted, ``a[].b`` flattens lists."""

    source: str
    fields: dict[str, str]
    list_path: str = ""
    filters: dict[str, object] = field(default_factory=dict)
    url_template: str = ""
    recurrence: dict[str, str] = field(default_factory=dict)
    horizon_days: int = 30
    area: str = ""
    agenda_url: str = ""


def source_flags(v: Column, filters: dict[str, object]) -> Column:
    """What the source itself marks as open: list = any of, bool = truthiness, else equality."""
    keep = F.lit(True)
    for path, wanted in filters.items():
        raw = raw_at(v, path)
        if isinstance(wanted, bool):
            truth = F.coalesce((raw != "") & ~F.lower(raw).isin("false", "0", "null"), F.lit(False))
            keep &= truth == F.lit(wanted)
        elif isinstance(wanted, (list, tuple)):
            keep &= F.coalesce(raw.isin(*[str(w) for w in wanted]), F.lit(False))
        else:
            keep &= F.coalesce(F.lower(raw) == str(wanted).lower(), F.lit(False))
    return keep


def from_template(v: Column, template: str) -> Column:
    """Fill ``{path}`` slots; blank when a slot was left or the address ends in a slash."""
    pieces = re.split(r"\{([^}]+)\}", template)
    out = F.concat(*[text_at(v, p) if i % 2 else F.lit(p) for i, p in enumerate(pieces)])
    return F.when(out.endswith("/") | F.contains(out, F.lit("{")), F.lit("")).otherwise(out)


def with_sessions(rows: DataFrame, m: JsonMapping, as_of: Column) -> DataFrame:
    """Adds starts, cadence and fin: weekly blocks become sessions, else one dated row.

    Each step is its own column, so a parsed date is computed once per row.
    """
    f, v = m.fields, F.col("item")
    rows = compute_once(rows, _start=dates.parse_date_es(text_at(v, f.get("inicio", "")), as_of),
                        _end=dates.parse_date_es(text_at(v, f["fin"]), as_of) if f.get("fin") else
                        F.lit(None).cast("timestamp_ntz"))
    if f.get("hora_inicio"):
        rows = rows.withColumn("_hh", dates.parse_time(text_at(v, f["hora_inicio"])))
        rows = rows.withColumn("_start", F.when(F.col("_hh").isNotNull(), dates.at_time(
            F.col("_start"), F.col("_hh"))).otherwise(F.col("_start")))
    if f.get("hora_inicio_segundos"):
        rows = rows.withColumn("_sec", raw_at(v, f["hora_inicio_segundos"]).try_cast("int"))
        hhmm = F.format_string("%02d:%02d", F.floor(F.col("_sec") / 3600), F.floor(F.col("_sec") % 3600 / 60))
        rows = rows.withColumn("_start", F.when(F.col("_sec").between(0, 86399), dates.at_time(
            F.col("_start"), hhmm)).otherwise(F.col("_start")))
    start, end = F.col("_start"), F.col("_end")
    single = F.when(start.isNotNull(), F.array(start)).otherwise(F.array().cast("array<timestamp_ntz>"))
    if not m.recurrence:
        return rows.withColumns({"starts": single, "cadence": F.lit(""), "fin": end})
    rec = {"dias": "dias", "hora_inicio": "inicio", "hora_fin": "fin", **m.recurrence}
    rows = rows.withColumn("_blocks", values(v, rec["bloques"]))
    words = F.array_join(F.flatten(F.transform("_blocks", lambda b: F.coalesce(
        F.try_variant_get(b, _json_path(rec["dias"]), "array<string>"),
        F.array(F.try_variant_get(b, _json_path(rec["dias"]), "string"))))), " ")
    hours = lambda k: F.transform("_blocks", lambda b: dates.parse_time(
        F.try_variant_get(b, _json_path(rec[k]), "string")))
    rows = compute_once(rows, _days=dates.parse_weekdays(words), _h0s=hours("hora_inicio"), _h1s=hours("hora_fin"))
    # The closing hour belongs to the first block that declares an opening hour.
    at = F.array_position(F.transform("_h0s", lambda h: h.isNotNull()), F.lit(True)).cast("int") - 1
    rows = rows.withColumns({"_h0": F.get("_h0s", at), "_h1": F.get("_h1s", at)})
    weekly = start.isNotNull() & (F.size("_days") > 0)
    return rows.withColumns({
        "starts": F.when(weekly, dates.future_sessions(F.col("_days"), F.col("_h0"), start, end, as_of,
                                                       m.horizon_days)).otherwise(single),
        "cadence": F.when(weekly, dates.cadence_phrase(F.col("_days"), F.col("_h0"), F.col("_h1"))).otherwise(""),
        "fin": F.when(~weekly, end)})


def extract_json_mapped(captures: DataFrame, m: JsonMapping, as_of: Column) -> DataFrame:
    """Candidates of one mapped JSON source."""
    f, v = m.fields, F.col("item")
    rows = items(captures, m.list_path).filter(source_flags(v, m.filters))
    rows = compute_once(rows, titulo=text_at(v, f.get("titulo", "titulo")), _desc=text_at(v, f.get("descripcion_corta", "")),
                        _link=text_at(v, f.get("link", "")), _addr=text_at(v, f.get("lugar_direccion", "")),
                        _place=text_at(v, f.get("lugar_nombre", "")))
    rows = with_sessions(rows.filter("titulo != ''"), m, as_of)
    described = F.when(F.col("cadence") != "", F.trim(F.concat(F.col("cadence"), F.lit(". "), F.col("_desc")))
                       ).otherwise(F.col("_desc"))
    link = F.when(F.col("_link").startswith("//"), F.concat(F.lit("https:"), "_link")).otherwise(F.col("_link"))
    options = [link] + ([from_template(v, m.url_template)] if m.url_template else [])
    if m.agenda_url:
        options.append(F.when(~is_machine_url(F.lit(m.agenda_url)), F.lit(m.agenda_url)))
    link = F.coalesce(*[F.when(o != "", o) for o in options], F.lit(""))
    free = F.try_variant_get(v, _json_path(f["es_gratis"]), "boolean") if f.get("es_gratis") else \
        F.lit(None).cast("boolean")
    base = rows.select(
        "titulo", text_at(v, f.get("categoria", "")).alias("categoria"),
        summarise(described).alias("descripcion_corta"), F.when(F.size("starts") == 1, F.col("fin")).alias("fin"),
        F.when(F.col("_place") != "", F.col("_place")).otherwise(F.lit(m.source)).alias("lugar_nombre"),
        F.col("_addr").alias("lugar_direccion"),
        detect_area(text_at(v, f.get("comuna", "")), F.col("_addr"), F.lit(m.area)).alias("comuna"),
        free.alias("es_gratis"), F.when(free, "Gratis").otherwise("").alias("precio_texto"),
        F.lit("json").alias("fuente_tipo"), F.lit(m.source).alias("fuente_nombre"), link.alias("fuente_url"),
        text_at(v, f.get("imagen_url", "")).alias("imagen_url"),
        text_at(v, f.get("id_externo", "")).alias("id_externo"), "captura", "pos",
        F.posexplode_outer("starts").alias("sesion", "inicio")).filter("inicio is not null")
    return as_candidates(base.withColumns({
        "seq": order_number(F.col("captura"), F.col("pos"), F.col("sesion")), "todo_el_dia": F.lit(False)}))


def epoch_local(seconds: Column, zone: str = LOCAL_ZONE) -> Column:
    """Unix seconds as local wall clock, whatever the session zone is."""
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


# Preferred sizes of a featured image.
IMAGE_SIZES = ("medium_large", "large", "medium", "full")


def featured_image(v: Column) -> Column:
    media = "_embedded.wp:featuredmedia"
    first = F.get(F.try_variant_get(v, _json_path(media), "array<variant>"), F.lit(0))
    sized = [F.try_variant_get(first, _json_path(f"media_details.sizes.{s}.source_url"), "string")
             for s in IMAGE_SIZES]
    return F.coalesce(*[F.when(c != "", c) for c in (
        F.try_variant_get(v, "$.jetpack_featured_media_url", "string"), *sized,
        F.try_variant_get(first, "$.source_url", "string"))], F.lit(""))


def rendered(v: Column, name: str) -> Column:
    return strip_html(F.coalesce(F.try_variant_get(v, f"$.{name}.rendered", "string"),
                                 F.try_variant_get(v, f"$.{name}", "string")))


def extract_cms_posts(captures: DataFrame, source: str, as_of: Column, area: str = "",
                      meta_date: str = "", meta_link: str = "") -> DataFrame:
    """Generic posts: a declared meta date beats the date read from the text."""
    v = F.col("item")
    rows = compute_once(items(captures), titulo=rendered(v, "title"), _c=rendered(v, "content"), _e=rendered(v, "excerpt"),
                        fecha_publicacion=dates.parse_date_es(F.try_variant_get(v, "$.date", "string"), as_of))
    rows = rows.filter("titulo != ''").withColumn("_b", F.when(F.col("_c") != "", F.col("_c")).otherwise(F.col("_e")))
    rows = rows.withColumn("_t", F.concat_ws(". ", "titulo", "_b"))
    declared = []
    if meta_date:
        rows = rows.withColumn("_m", F.try_variant_get(v, _json_path(f"meta.{meta_date}"), "string"))
        declared = [epoch_local(F.col("_m").try_cast("bigint")), dates.parse_date_es(F.col("_m"), as_of)]
    link = F.trim(F.coalesce(F.try_variant_get(v, _json_path(f"meta.{meta_link}"), "string"), F.lit(""))) \
        if meta_link else F.lit("")
    rows = compute_once(rows, _p=parse_price_clp(F.col("_t")))
    price = F.col("_p")
    return as_candidates(rows.select(
        order_number(F.col("captura"), F.col("pos")).alias("seq"), "titulo",
        summarise(F.col("_b")).alias("descripcion_corta"),
        F.coalesce(*declared, dates.parse_date_es(F.col("_t"), as_of, F.col("fecha_publicacion"))).alias("inicio"),
        F.lit(source).alias("lugar_nombre"), detect_area(F.col("_t"), F.lit(area)).alias("comuna"),
        price["price"].alias("precio_clp"), price["free"].alias("es_gratis"), price["note"].alias("precio_texto"),
        F.lit("wordpress").alias("fuente_tipo"), F.lit(source).alias("fuente_nombre"),
        raw_at(v, "link").alias("fuente_url"), link.alias("link_entradas"), featured_image(v).alias("imagen_url"),
        raw_at(v, "id").alias("id_externo"), "fecha_publicacion"))


def extract_calendar_api(captures: DataFrame, source: str, as_of: Column, area: str = "") -> DataFrame:
    """Structured calendar plug-in: dates, venue, cost and categories are fields."""
    v = F.col("item")
    rows = items(captures, "events").withColumn("titulo", text_at(v, "title")).filter("titulo != ''")
    venue = text_at(v, "venue.venue")
    address = F.concat_ws(", ", *[F.when(text_at(v, p) != "", text_at(v, p)) for p in ("venue.address", "venue.city")])
    cost = F.coalesce(raw_at(v, "cost"), F.lit(""))
    rows = compute_once(rows, _p=parse_price_clp(F.when(cost != "", cost).otherwise(raw_at(v, "description"))))
    price = F.col("_p")
    no_values = F.try_variant_get(v, "$.cost_details.values", "array<variant>")
    open_door = (cost == "") & (F.size(no_values) == 0)
    return as_candidates(rows.select(
        order_number(F.col("captura"), F.col("pos")).alias("seq"), "titulo",
        text_at(v, "categories[].name").alias("categoria"),
        summarise(raw_at(v, "description")).alias("descripcion_corta"),
        dates.parse_date_es(raw_at(v, "start_date"), as_of).alias("inicio"),
        dates.parse_date_es(raw_at(v, "end_date"), as_of).alias("fin"),
        F.coalesce(F.try_variant_get(v, "$.all_day", "boolean"), F.lit(False)).alias("todo_el_dia"),
        F.when(venue != "", venue).otherwise(F.lit(source)).alias("lugar_nombre"), address.alias("lugar_direccion"),
        detect_area(address, venue, F.lit(area)).alias("comuna"),
        F.when(open_door, F.lit(0)).otherwise(price["price"]).alias("precio_clp"),
        F.when(open_door, F.lit(True)).otherwise(price["free"]).alias("es_gratis"),
        F.when(price["note"] != "", price["note"]).otherwise(cost).alias("precio_texto"),
        F.lit("wordpress").alias("fuente_tipo"), F.lit(source).alias("fuente_nombre"),
        F.coalesce(F.when(raw_at(v, "url") != "", raw_at(v, "url")), raw_at(v, "link"), F.lit("")).alias("fuente_url"),
        F.coalesce(raw_at(v, "website"), F.lit("")).alias("link_entradas"),
        F.coalesce(raw_at(v, "image.url"), F.lit("")).alias("imagen_url"), raw_at(v, "id").alias("id_externo")))


def unwrap_ajax_html(captures: DataFrame) -> DataFrame:
    """Captures whose JSON wrapper carries the page in ``content``."""
    html = F.try_variant_get(F.try_parse_json(F.col("body")), "$.content", "string")
    return captures.withColumn("body", html).filter(F.coalesce("body", F.lit("")) != "")


def extract_ticket_api(captures: DataFrame, as_of: Column, source: str = "Ticketmaster") -> DataFrame:
    """Ticket listing: first venue, lowest first price range, wide image preferred."""
    v = F.col("item")
    rows = items(captures, "_embedded.events").withColumn("titulo", squeeze(F.coalesce(raw_at(v, "name"), F.lit(""))))
    day = F.coalesce(raw_at(v, "dates.start.dateTime"), raw_at(v, "dates.start.localDate"), F.lit(""))
    local = F.when(raw_at(v, "dates.start.localTime").isNotNull(), F.concat_ws(
        " ", raw_at(v, "dates.start.localDate"), raw_at(v, "dates.start.localTime")))
    rows = compute_once(rows, _s=dates.parse_date_es(day, as_of), _l=dates.parse_date_es(local, as_of))
    start = F.when(F.hour("_s") == 0, F.coalesce("_l", "_s")).otherwise(F.col("_s"))
    site = F.get(F.try_variant_get(v, "$._embedded.venues", "array<variant>"), F.lit(0))
    at = lambda p: F.coalesce(raw_at(site, p), F.lit(""))
    ranges = F.try_variant_get(v, "$.priceRanges", "array<variant>")
    price = F.when(F.size(ranges) > 0, F.coalesce(
        F.try_variant_get(F.get(ranges, F.lit(0)), "$.min", "string"), F.lit("0")).try_cast("double").cast("int"))
    kind = F.get(F.try_variant_get(v, "$.classifications", "array<variant>"), F.lit(0))
    names = [F.try_variant_get(kind, p, "string") for p in ("$.segment.name", "$.genre.name")]
    images = F.try_variant_get(v, "$.images", "array<variant>")
    wide = F.filter(images, lambda i: F.coalesce(F.try_variant_get(i, "$.width", "int"), F.lit(0)) >= 640)
    image = F.try_variant_get(F.get(F.when(F.size(wide) > 0, wide).otherwise(images), F.lit(0)), "$.url", "string")
    where = F.concat_ws(", ", *[F.when(at(p) != "", at(p)) for p in ("address.line1", "city.name")])
    return as_candidates(rows.withColumn("inicio", start).filter("titulo != '' and inicio is not null").select(
        order_number(F.col("captura"), F.col("pos")).alias("seq"), "titulo",
        F.concat_ws(" / ", *[F.when(n != "", n) for n in names]).alias("categoria"),
        summarise(F.coalesce(raw_at(v, "info"), raw_at(v, "pleaseNote"))).alias("descripcion_corta"), "inicio",
        F.lit(False).alias("todo_el_dia"), at("name").alias("lugar_nombre"), where.alias("lugar_direccion"),
        detect_area(at("city.name"), at("address.line1"), at("name")).alias("comuna"),
        price.alias("precio_clp"), (price == 0).alias("es_gratis"),
        F.when(price > 0, F.concat(F.lit("desde "), pesos(price))).otherwise("").alias("precio_texto"),
        F.lit("api").alias("fuente_tipo"), F.lit(source).alias("fuente_nombre"), raw_at(v, "url").alias("fuente_url"),
        raw_at(v, "url").alias("link_entradas"), F.coalesce(image, F.lit("")).alias("imagen_url"),
        raw_at(v, "id").alias("id_externo")))
