"""Pages: structured data, event cards, detail pages, venue listings, showings, tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kermesse.functions import dates
from kermesse.functions.money import parse_price_clp, pesos
from kermesse.functions.places import detect_area, in_bbox
from kermesse.functions.text import (absolute_url, fold_text, is_machine_url, squeeze, strip_html, summarise,
                                     unescape)
from kermesse.operators.columns import compute_once
from kermesse.operators.skew import top_k
from kermesse.sources.captures import as_candidates, meta_content, nested, order_number, visible_text
from kermesse.session import ship_package
from kermesse.sources.json_items import raw_at
from kermesse.vocab import calendar as cal
from kermesse.vocab.labels import MAX_PRICE_CLP
from kermesse.vocab.places import BOX_CITY_PAGE


@dataclass(frozen=True)
class PageSource:
    """Reading options of one page source."""

    source: str
    base: str
    area: str = ""
    agenda_url: str = ""
    kind: str = "html"
    card: str = ""
    title: str = ""
    link: str = ""
    date: str = ""
    date_attribute: str = "data-date"
    hour: str = ""
    category: str = ""
    place: str = ""
    rooms: dict[str, tuple[str, str]] = field(default_factory=dict)


# -- structured data ---------------------------------------------------------------------

def jsonld_nodes(captures: DataFrame) -> DataFrame:
    """One row per node of the structured data of each page (lists and graphs opened)."""
    scripts = F.regexp_extract_all(F.col("body"), F.lit(
        r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), 1)
    # Sources leave raw control characters inside strings, which strict JSON refuses.
    # Scripts, documents and lists are columns of their own, so each page is searched and parsed once.
    docs = compute_once(captures, _scripts=scripts).select("source_id", "url", F.col("seq").alias("captura"),
                                                           F.posexplode("_scripts").alias("doc", "json"))
    docs = compute_once(docs, v=F.try_parse_json(F.regexp_replace("json", r"[\x00-\x1f]", " "))).filter("v is not null")
    listed = F.coalesce(F.try_variant_get("v", "$.@graph", "array<variant>"),
                        F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    return compute_once(docs, _listed=listed).select("source_id", "url", "captura", "doc", F.posexplode("_listed").alias("n", "item"))


def extract_jsonld_events(captures: DataFrame, src: PageSource, as_of: Column) -> DataFrame:
    """Candidates from nodes whose type names an event."""
    v = F.col("item")
    kinds = F.coalesce(F.try_variant_get(v, "$.@type", "array<string>"), F.array(raw_at(v, "@type")))
    rows = jsonld_nodes(captures).filter(F.exists(kinds, lambda t: F.contains(t, F.lit("Event"))))
    text = lambda p: F.coalesce(raw_at(v, p), F.lit(""))
    plain = F.when(F.schema_of_variant(F.try_variant_get(v, "$.location.address", "variant")) == "STRING",
                   text("location.address"))
    parts = F.concat_ws(", ", *[F.when(text(p) != "", text(p)) for p in (
        "location.address.streetAddress", "location.address.addressLocality")])
    address, place = F.coalesce(plain, parts), text("location.name")
    offer = F.coalesce(F.get(F.try_variant_get(v, "$.offers", "array<variant>"), F.lit(0)),
                       F.try_variant_get(v, "$.offers", "variant"))
    given = [F.try_variant_get(offer, p, "string") for p in ("$.price", "$.lowPrice")]
    raw = F.trim(F.coalesce(*[F.when(g != "", g) for g in given], F.lit("")))
    raw = F.when(raw.rlike(r"^\d{1,3}(?:\.\d{3})+$"), F.replace(raw, F.lit("."), F.lit(""))).otherwise(raw)
    image = F.coalesce(F.get(F.try_variant_get(v, "$.image", "array<string>"), F.lit(0)), text("image"))
    rows = compute_once(rows, _raw=raw, _addr=address, _place=place, _img=image)
    said, number = parse_price_clp(F.col("_raw")), F.col("_raw").try_cast("double").cast("int")
    zero, plain_number = F.col("_raw").isin("0", "0.0", "0.00"), number.between(1, MAX_PRICE_CLP)
    rows = compute_once(rows, _said=said)
    unsaid = F.col("_said.price").isNull()
    point = [F.try_variant_get(v, f"$.location.geo.{k}", "double") for k in ("latitude", "longitude")]
    point = [F.coalesce(p, F.try_variant_get(v, f"$.location.geo.{k}", "string").try_cast("double"))
             for p, k in zip(point, ("latitude", "longitude"))]
    whole = point[0].isNotNull() & point[1].isNotNull()
    url = absolute_url(F.trim(text("url")), F.lit(src.base))
    agenda = F.lit(src.agenda_url)
    url = F.when((url == "") & (agenda != "") & ~is_machine_url(agenda), agenda).otherwise(url)
    return as_candidates(rows.select(
        order_number(F.col("captura"), nested(F.col("doc"), F.col("n"))).alias("seq"),
        strip_html(text("name")).alias("titulo"), summarise(text("description")).alias("descripcion_corta"),
        dates.parse_date_es(text("startDate"), as_of).alias("inicio"),
        dates.parse_date_es(text("endDate"), as_of).alias("fin"), F.lit(False).alias("todo_el_dia"),
        F.when(F.col("_place") != "", F.col("_place")).otherwise(F.lit(src.source)).alias("lugar_nombre"),
        F.col("_addr").alias("lugar_direccion"),
        detect_area(F.col("_addr"), F.col("_place"), F.lit(src.area)).alias("comuna"),
        F.when(whole, point[0]).alias("lat"), F.when(whole, point[1]).alias("lon"),
        F.when(zero, F.lit(0)).when(unsaid & plain_number, number).otherwise(F.col("_said.price")).alias("precio_clp"),
        F.when(zero, F.lit(True)).when(unsaid & plain_number, F.lit(False)).otherwise(F.col("_said.free")).alias("es_gratis"),
        F.when(unsaid & plain_number & ~zero, F.concat(F.lit("desde "), pesos(number)))
        .otherwise(F.col("_said.note")).alias("precio_texto"),
        F.lit(src.kind).alias("fuente_tipo"), F.lit(src.source).alias("fuente_nombre"), url.alias("fuente_url"),
        F.coalesce("_img", F.lit("")).alias("imagen_url"), F.col("url").alias("id_externo")))


# -- cards -------------------------------------------------------------------------------

# Card selectors tried when a source declares none.
DEFAULT_CARDS = ("[data-date]", "article.evento", ".evento", ".event", ".eventon_list_event",
                 "article.event", ".card-evento", ".agenda-item")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Cards(HTMLParser):
    """Reads the parts of each card element; selectors are ``tag``, ``.class``, ``[attr]`` mixes."""

    def __init__(self, card: str, parts: dict[str, str], attribute: str):
        super().__init__(convert_charrefs=True)
        self.card, self.parts, self.attribute = card, parts, attribute
        self.stack: list[tuple[str, int]] = []
        self.open: list[dict] = []
        self.done: list[dict] = []

    @staticmethod
    def fits(selector: str, tag: str, attrs: dict[str, str | None]) -> bool:
        classes = (attrs.get("class") or "").split()
        for option in selector.split(","):
            name, _, attr = option.strip().rstrip("]").partition("[")
            want_tag, *want = name.split(".")
            if (not want_tag or want_tag == tag) and all(c in classes for c in want) and (
                    not attr or attr in attrs):
                return True
        return False

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        depth = len(self.stack)
        for card in self.open:
            for part, selector in self.parts.items():
                if selector and part not in card["at"] and self.fits(selector, tag, attrs):
                    card["at"][part] = depth
                    card["text"][part] = []
                    if part == "link":
                        card["href"] = attrs.get("href") or ""
        if self.fits(self.card, tag, attrs):
            self.open.append({"depth": depth, "at": {}, "text": {}, "all": [], "href": "",
                              "classes": (attrs.get("class") or "").split(),
                              "date_attr": attrs.get(self.attribute) or "", "live": set()})
            self.done.append(self.open[-1])
        if tag not in _VOID:
            self.stack.append((tag, depth))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break
        depth = len(self.stack)
        self.open = [c for c in self.open if c["depth"] < depth]
        for card in self.open:
            for part, at in card["at"].items():
                if at >= depth:
                    card["at"][part] = 10 ** 9

    def handle_data(self, data):
        inside = any(t in ("script", "style") for t, _ in self.stack)
        text = data.strip()
        if not text or inside:
            return
        depth = len(self.stack)
        for card in self.open:
            card["all"].append(text)
            for part, at in card["at"].items():
                if at < depth:
                    card["text"][part].append(text)


#: Cards that a Python worker holds before it hands them on.
CARDS_AT_ONCE = 2_000
_CARD_PARTS = ("titulo", "fecha", "hora", "categoria", "lugar")
_CARD_SCHEMA = ("captura bigint, pos int, href string, date_attr string, clases array<string>, texto string, "
                + ", ".join(f"{p} string" for p in _CARD_PARTS))


def _card_batches(batches: Iterator, selectors: tuple[str, ...], parts: dict, attribute: str, limit: int | None) -> Iterator:
    """Cards of batches of pages. One page at a time becomes Python text, and cards leave as soon as there are enough."""
    import pyarrow as pa

    schema = pa.schema([("captura", pa.int64()), ("pos", pa.int32()), ("href", pa.string()), ("date_attr", pa.string()),
                        ("clases", pa.list_(pa.string())), ("texto", pa.string()), *((p, pa.string()) for p in _CARD_PARTS)])
    for batch in batches:
        out: list[dict] = []
        for seq, body in zip(*batch.columns):
            for selector in selectors:
                parser = _Cards(selector, parts, attribute)
                parser.feed(body.as_py() or "")
                if parser.done:
                    break
            for pos, card in enumerate(parser.done[:limit]):
                text = {p: " ".join(card["text"].get(p, [])) for p in _CARD_PARTS}
                out.append({"captura": seq.as_py(), "pos": pos, "href": card["href"], "date_attr": card["date_attr"],
                            "clases": card["classes"], "texto": " ".join(card["all"]), **text})
                if len(out) >= CARDS_AT_ONCE:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)


def card_parts(captures: DataFrame, src: PageSource, limit: int | None = None) -> DataFrame:
    """Raw texts of each card; pages are parsed where they lie, one at a time."""
    parts = {"titulo": src.title or "h1,h2,h3,h4", "link": src.link or "a[href]", "fecha": src.date,
             "hora": src.hour, "categoria": src.category or "small", "lugar": src.place}
    selectors, attribute = (src.card,) if src.card else tuple(DEFAULT_CARDS), src.date_attribute

    def read(batches: Iterator) -> Iterator:
        yield from _card_batches(batches, selectors, parts, attribute, limit)

    ship_package(captures.sparkSession)
    return captures.select("seq", "body").mapInArrow(read, _CARD_SCHEMA)


def extract_html_cards(captures: DataFrame, src: PageSource, as_of: Column) -> DataFrame:
    """Structured data when the page has it, else its cards."""
    structured = extract_jsonld_events(captures, src, as_of)
    has = jsonld_nodes(captures).filter(F.contains(F.coalesce(raw_at(F.col("item"), "@type"), F.lit("")), F.lit("Event"))
                                        ).select(F.col("captura").alias("seq")).distinct()
    cards = card_parts(captures.join(has, "seq", "left_anti"), src)
    c = F.col
    rows = compute_once(cards, **{x: squeeze(c(x)) for x in ("texto", *_CARD_PARTS)}).filter("titulo != ''")
    by_attr = dates.parse_date_es(c("date_attr"), as_of)
    by_text = dates.parse_date_es(F.when(c("fecha") != "", c("fecha")).otherwise(c("texto")), as_of)
    rows = compute_once(rows, inicio=F.coalesce(by_attr, by_text)).filter("inicio is not null")
    tail = F.get(F.split(c("fecha"), r"\s*[-–—]\s*|\s+al\s+|\s+hasta\s+", 2), F.lit(1))
    ranged = (c("date_attr") == "") & (c("fecha") != "")
    rows = compute_once(rows, _until=dates.parse_date_es(F.when(ranged, tail), as_of), _hh=dates.parse_time(c("hora")))
    midnight = (F.hour("inicio") == 0) & (F.minute("inicio") == 0)
    rows = rows.withColumns({
        "fin": F.when(c("_until") >= c("inicio"), c("_until")),
        "inicio": F.when(midnight & c("_hh").isNotNull(), dates.at_time(c("inicio"), c("_hh"))).otherwise(c("inicio"))})
    room_place, room_area = F.lit(None).cast("string"), F.lit("")
    for css, (place, area) in reversed(src.rooms.items()):
        here = F.array_contains("clases", css)
        room_place = F.when(here, F.lit(place)).otherwise(room_place)
        room_area = F.when(here, F.lit(area)).otherwise(room_area)
    place = F.coalesce(F.when(c("lugar") != "", F.col("lugar")), room_place, F.lit(src.source))
    about = c("texto")
    for read_already in ("titulo", "lugar", "fecha"):
        about = F.when(c(read_already) != "", F.replace(about, c(read_already), F.lit(" "))).otherwise(about)
    rows = compute_once(rows, _about=squeeze(about), _p=parse_price_clp(c("texto")), _place=place, _area=room_area)
    href = absolute_url(c("href"), F.lit(src.base))
    cards_out = as_candidates(rows.select(
        order_number(c("captura"), c("pos")).alias("seq"), "titulo", "categoria",
        F.when(F.length("_about") < 25, "").otherwise(summarise(c("_about"), 150, is_html=False)).alias("descripcion_corta"),
        "inicio", "fin", c("_place").alias("lugar_nombre"),
        detect_area(c("_area"), c("texto"), F.lit(src.area)).alias("comuna"), c("_p.price").alias("precio_clp"),
        c("_p.free").alias("es_gratis"), c("_p.note").alias("precio_texto"), F.lit(src.kind).alias("fuente_tipo"),
        F.lit(src.source).alias("fuente_nombre"),
        F.when(href != "", href).otherwise(F.lit(src.agenda_url)).alias("fuente_url")))
    return structured.unionByName(cards_out)


# -- links and detail pages --------------------------------------------------------------

def extract_links(captures: DataFrame, base: Column, include: str = "", exclude: tuple[str, ...] = (),
                  shallow_ok: bool = False) -> DataFrame:
    """source_id, page_url, link, pos: absolute links without query, first occurrence order."""
    href = F.regexp_extract_all(F.col("body"), F.lit(r"(?is)<a\b[^>]*?\bhref=[\"']([^\"']*)[\"']"), 1)
    rows = captures.select("source_id", F.col("url").alias("page_url"), F.col("seq").alias("captura"),
                           base.alias("_base"), F.posexplode(href).alias("pos", "raw"))
    if include:
        rows = rows.filter(F.contains("raw", F.lit(include)))
    rows = rows.withColumn("_abs", absolute_url(unescape(F.col("raw")), F.col("_base"))).filter(F.col("_abs").startswith("http"))
    link = F.regexp_replace(F.substring_index("_abs", "?", 1), "/+$", "")
    rows = rows.withColumn("link", link)
    for part in exclude:
        rows = rows.filter(~F.contains(F.lower("link"), F.lit(part.lower())))
    if not shallow_ok:
        deep = F.length("link") - F.length(F.replace(F.col("link"), F.lit("/"), F.lit(""))) >= 3
        rows = rows.filter(deep & (F.col("link") != F.regexp_replace("_base", "/+$", "")))
    return rows.groupBy("source_id", "page_url", "captura", "link").agg(F.min("pos").alias("pos"))


def extract_detail_page(entries: DataFrame, captures: DataFrame, src: PageSource, as_of: Column) -> DataFrame:
    """Structured data of each entry page, else its title and the date of its text.

    ``entries``: entry_url, publicado. A lone closing date makes the publication day the start.
    """
    pages = captures.groupBy(F.col("url").alias("entry_url")).agg(
        F.min(F.struct("seq", "source_id", "body")).alias("p"))
    opened = entries.groupBy("entry_url").agg(F.min("publicado").alias("publicado")).join(pages, "entry_url").select(
        F.col("entry_url").alias("url"), "publicado", "p.seq", "p.source_id", "p.body")
    structured = extract_jsonld_events(opened, src, as_of).filter("inicio is not null")
    number = lambda k: F.regexp_extract("body", rf'"?{k}\\?"?\s*:\s*\\?"?(-?\d+\.\d{{3,}})', 1).try_cast("double")
    spots = opened.select(F.col("url").alias("id_externo"), number("latitude").alias("_la"), number("longitude").alias("_lo"))
    inside = in_bbox(F.col("_la"), F.col("_lo"), BOX_CITY_PAGE) & F.col("lat").isNull()
    rich = structured.join(spots, "id_externo", "left").withColumns({
        "lat": F.when(inside, F.col("_la")).otherwise(F.col("lat")),
        "lon": F.when(inside, F.col("_lo")).otherwise(F.col("lon")),
        "fuente_url": F.when(F.coalesce("fuente_url", F.lit("")) != "", F.col("fuente_url")).otherwise(F.col("id_externo")),
        "fuente_tipo": F.lit("sitemap")})
    plain = opened.join(structured.select(F.col("id_externo").alias("url")).distinct(), "url", "left_anti")
    og = meta_content(F.col("body"), "og:title")
    head = strip_html(F.regexp_extract("body", r"(?is)<title[^>]*>(.*?)</title>", 1))
    rows = compute_once(plain, _t=F.when(og != "", og).otherwise(head), _x=visible_text(F.col("body"))).filter("_t != ''")
    rows = compute_once(rows, _d=dates.parse_date_es(F.col("_x"), as_of, F.col("publicado")), _p=parse_price_clp(F.col("_x")))
    closing = dates.parse_date_es(F.regexp_extract("_x", r"(?iu)\bhasta\s+(?:el\s+)?([^,.;]*)", 1), as_of, F.col("publicado"))
    rows = compute_once(rows, _lone=F.coalesce(closing.cast("date") == F.col("_d").cast("date"), F.lit(False))
                        & F.col("publicado").isNotNull())
    lone = F.col("_lone")
    title = F.trim(F.substring_index(F.substring_index("_t", "|", 1), " - ", 1))
    text_rows = as_candidates(rows.filter("_d is not null").select(
        order_number(F.col("seq"), F.lit(0)).alias("seq"), title.alias("titulo"),
        summarise(F.col("_x"), 180, is_html=False).alias("descripcion_corta"),
        F.when(lone, F.col("publicado").cast("date").cast("timestamp_ntz")).otherwise(F.col("_d")).alias("inicio"),
        F.when(lone, F.col("_d")).alias("fin"), F.lit(src.source).alias("lugar_nombre"),
        detect_area(F.col("_x"), F.lit(src.area)).alias("comuna"), F.col("_p.price").alias("precio_clp"),
        F.col("_p.free").alias("es_gratis"), F.col("_p.note").alias("precio_texto"), F.lit("sitemap").alias("fuente_tipo"),
        F.lit(src.source).alias("fuente_nombre"), F.col("url").alias("fuente_url"),
        meta_content(F.col("body"), "og:image").alias("imagen_url")))
    return as_candidates(rich).unionByName(text_rows)


# -- venue listings ----------------------------------------------------------------------

def extract_two_level_listing(index: DataFrame, venues: DataFrame, src: PageSource, as_of: Column,
                              venue_part: str = "/cartelera/", event_part: str = "/evento/",
                              extra: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """Index page -> venue pages -> event anchors, each event address once; ``limit`` keeps a source's first venues."""
    base = F.lit(src.base)
    links = extract_links(index, base, venue_part, shallow_ok=True)
    chosen = (links if limit is None else top_k(links, ["source_id"], [F.col("captura"), F.col("pos")], limit)).select("source_id", "link")
    if extra:
        more = index.select("source_id").distinct().withColumn("link", F.explode(F.array(*[F.lit(
            e if e.startswith("http") else f"{src.base.rstrip('/')}{venue_part}{e}") for e in extra])))
        chosen = chosen.unionByName(more).distinct()
    pages = chosen.join(venues.withColumn("link", F.regexp_replace("url", "/+$", "")).drop("source_id"), "link")
    page_title = strip_html(F.regexp_extract("body", r"(?is)<title[^>]*>(.*?)</title>", 1))
    pages = pages.filter(~page_title.rlike(r"(?iu)eventos\s+en\s*$"))
    anchors = pages.select("seq", F.posexplode(F.regexp_extract_all("body", F.lit(
        r"(?is)<a\b[^>]*\bhref=[\"'][^\"']*[\"'][^>]*>.*?</a>"), 0)).alias("pos", "a"))
    href = F.regexp_extract("a", r"(?is)\bhref=[\"']([^\"']*)[\"']", 1)
    parts = F.filter(F.transform(F.regexp_extract_all("a", F.lit(
        r"(?is)<(?:p|h2|h3|h4|span|div)\b[^>]*>(.*?)</(?:p|h2|h3|h4|span|div)>"), 1), lambda x: strip_html(x)), lambda t: t != "")
    rows = compute_once(anchors.filter(F.contains(href, F.lit(event_part))), parts=parts, whole=strip_html(F.col("a")),
                        href=F.substring_index(absolute_url(href, base), "?", 1))
    rest = F.slice("parts", 2, F.greatest(F.size("parts"), F.lit(1)))
    dated = F.transform(rest, lambda t: dates.parse_date_es(t, as_of))
    rows = compute_once(rows, _rest=rest, _at=F.array_position(F.transform(dated, lambda d: d.isNotNull()), F.lit(True)))
    many = F.size("parts") >= 2
    title = F.when(many, F.get("parts", F.lit(0))).otherwise(F.col("whole"))
    when = F.when(many, F.get("_rest", F.col("_at").cast("int") - 1)).otherwise(F.col("whole"))
    where = F.when(~many, F.col("whole")).when(F.col("_at") > 0, F.array_join(F.slice(
        "_rest", F.col("_at").cast("int") + 1, F.greatest(F.size("_rest"), F.lit(1))), " ")).otherwise(F.array_join("_rest", " "))
    rows = rows.withColumns({"titulo": title, "_when": F.when(F.col("_at") > 0, when).when(~many, when), "_where": where})
    rows = compute_once(rows, inicio=F.coalesce(dates.parse_date_es(F.col("_when"), as_of),
                                                dates.parse_date_es(F.col("titulo"), as_of)))
    rows = rows.filter("titulo != '' and inicio is not null").withColumns({
        "seq": order_number(F.col("seq"), F.col("pos")), "_p": parse_price_clp(F.col("_where"))})
    place = F.trim(F.substring_index("_where", ",", 1))
    out = rows.select(
        "seq", "titulo", "inicio",
        F.when(place != "", place).otherwise(F.lit(src.source)).alias("lugar_nombre"),
        detect_area(F.col("_where"), F.lit(src.area)).alias("comuna"), F.col("_p.price").alias("precio_clp"),
        F.col("_p.free").alias("es_gratis"), F.col("_p.note").alias("precio_texto"),
        F.lit("carteleras").alias("fuente_tipo"), F.lit(src.source).alias("fuente_nombre"),
        F.col("href").alias("fuente_url"), F.col("href").alias("link_entradas"))
    once = out.groupBy("fuente_url").agg(F.min(F.struct("seq", F.struct(*out.columns).alias("r")))["r"].alias("r"))
    return as_candidates(once.select("r.*"))


# -- showings ----------------------------------------------------------------------------

# One showing is an hour followed by a title up to the next hour.
SHOWING = (r"(?iu)(\d{1,2})[:.](\d{2})\s*(?:hrs?\.?|horas?)?\s*(.+?)"
           r"(?=\s*\d{1,2}[:.]\d{2}\s*(?:hrs?\.?|horas?)|$)")


def extract_cinema_week(captures: DataFrame, src: PageSource, as_of: Column, address: str = "",
                        category: str = "cine") -> DataFrame:
    """One row per showing of the week; day sections carry a weekday class and a day number."""
    names = "|".join(cal.WEEKDAYS)
    start = rf"(?is)<(?:section|div)\b[^>]*class=[\"'][^\"']*\b(?:{names})\b[^\"']*[\"'][^>]*>"
    cut = F.split(F.regexp_replace("body", f"({start})", "\u0001$1"), "\u0001")
    rows = captures.select(F.col("seq").alias("captura"), "url", F.posexplode(F.slice(
        cut, 2, F.greatest(F.size(cut), F.lit(1)))).alias("sec", "html"))
    day = F.array_position(F.array(*[F.lit(n) for n in cal.WEEKDAYS]),
                           F.lower(F.regexp_extract("html", rf"(?iu)\b({names})\b", 1))) - 1
    heading = r"(?is)<h[1-6]\b[^>]*>(.*?)</h[1-6]>"
    number = F.regexp_extract(strip_html(F.regexp_extract("html", heading, 1)), r"(\d{1,2})", 1).try_cast("int")
    rows = rows.withColumns({"fecha": dates.date_from_weekday_and_day(day.cast("int"), number, as_of),
                             "texto": visible_text(F.regexp_replace("html", "(?s)^(.*?)" + heading.replace("(?is)", "(?is:") + ")", "$1"))})
    shows = rows.filter("fecha is not null").select("captura", "url", "sec", "fecha", F.posexplode(
        F.regexp_extract_all("texto", F.lit(SHOWING), 0)).alias("k", "f"))
    part = lambda i: F.regexp_extract("f", SHOWING, i)
    hh, mm = part(1).cast("int"), part(2).cast("int")
    shows = shows.withColumn("titulo", F.regexp_replace(squeeze(part(3)), r"^[ .\-–—]+|[ .\-–—]+$", ""))
    shows = shows.filter((F.col("titulo") != "") & (hh <= 23) & (mm <= 59)).withColumn("_p", parse_price_clp(F.col("titulo")))
    return as_candidates(shows.select(
        order_number(F.col("captura"), nested(F.col("sec"), F.col("k"))).alias("seq"),
        "titulo", F.lit(category).alias("categoria"),
        dates.at_time(F.col("fecha"), F.concat_ws(":", F.lpad(part(1), 2, "0"), part(2))).alias("inicio"),
        F.lit(src.source).alias("lugar_nombre"), F.lit(address).alias("lugar_direccion"),
        detect_area(F.lit(src.area), F.lit(address)).alias("comuna"), F.col("_p.price").alias("precio_clp"),
        F.col("_p.free").alias("es_gratis"), F.col("_p.note").alias("precio_texto"), F.lit("cine").alias("fuente_tipo"),
        F.lit(src.source).alias("fuente_nombre"), F.col("url").alias("fuente_url")))


# -- workshop tables ---------------------------------------------------------------------

# Header aliases (an alias also fits as a prefix).
TABLE_HEADERS = {
    "titulo": ("disciplina", "taller", "actividad", "ramo", "curso"),
    "dias": ("dia", "dias", "dia(s)", "jornada"),
    "horario": ("horario", "hora", "bloque"),
    "publico": ("edad", "categoria", "categoria - edad", "nivel"),
    "inicio": ("inicio", "comienzo", "desde"),
    "lugar": ("recinto", "lugar", "sede", "establecimiento"),
    "comuna": ("comuna", "barrio", "sector"),
}
ADDRESS_LABEL = r"(?iu)direcci[oó]n\s*:\s*(.+)"
IGNORED_ROW = r"(?iu)horario de funcionamiento|tel[eé]fono|mail|correo|domingos? y festivos"
GENERIC_TITLE = r"(?iu)^(bloque|grupo|turno|horario|nivel|cupo|secci[oó]n)\s*[nº#]?\s*\d+$"
LOOKS_LIKE_ADDRESS = r"(?iu)\b(av(da?)?\.?|avenida|calle|pasaje|psje\.?|camino|bandej[oó]n)\b|#\s*\d|\d{3,}"


def table_rows(captures: DataFrame) -> DataFrame:
    """captura, url, tabla, fila, celdas: every row of every table."""
    tables = captures.select(F.col("seq").alias("captura"), "url", F.posexplode(F.regexp_extract_all(
        "body", F.lit(r"(?is)<table\b[^>]*>.*?</table>"), 0)).alias("tabla", "t"))
    rows = tables.select("captura", "url", "tabla", F.posexplode(F.regexp_extract_all(
        "t", F.lit(r"(?is)<tr\b[^>]*>.*?(?=<tr\b|</tr>|</table>)"), 0)).alias("fila", "r"))
    cells = F.transform(F.regexp_extract_all("r", F.lit(r"(?is)<t[hd]\b[^>]*>.*?(?=<t[hd]\b|</t[hd]>|$)"), 0), lambda x: strip_html(x))
    return rows.select("captura", "url", "tabla", "fila", cells.alias("celdas"))


def extract_workshop_tables(captures: DataFrame, src: PageSource, as_of: Column, horizon: int = 30,
                            category: str = "") -> DataFrame:
    """Weekly sessions from tables whose header names an activity and its days."""
    w = Window.partitionBy("captura", "tabla")  # one table of one page
    rows = table_rows(captures)

    def header(cells: Column) -> Column:
        folded = F.transform(cells, lambda c: fold_text(c, "squeeze"))
        label = lambda c: F.coalesce(*[F.when(F.lit(False), "")] + [
            F.when(c.rlike("^(?:" + "|".join(a.replace("(", r"\(").replace(")", r"\)") for a in al) + ")"), F.lit(f))
            for f, al in TABLE_HEADERS.items()])
        return F.transform(folded, lambda c: F.when(c != "", label(c)))

    rows = rows.withColumn("_h", header(F.col("celdas")))
    is_head = F.array_contains("_h", "titulo") & F.array_contains("_h", "dias")
    rows = rows.withColumn("_head", F.min(F.when(is_head, F.col("fila"))).over(w)).filter("_head is not null")
    rows = rows.withColumn("_map", F.max(F.when(F.col("fila") == F.col("_head"), F.col("_h"))).over(w))
    line = F.trim(F.array_join(F.filter("celdas", lambda c: c != ""), " "))
    above = F.col("fila") < F.col("_head")
    labelled = F.regexp_extract(line, ADDRESS_LABEL, 1)
    loose = above & (F.size("celdas") == 1) & (line != "") & ~line.rlike(IGNORED_ROW) & (labelled == "")
    rows = rows.withColumns({
        "_addr": F.min(F.when(above & (labelled != ""), F.struct("fila", F.regexp_replace(
            squeeze(labelled), r"^[ .]+|[ .]+$", "").alias("v")))).over(w)["v"],
        "_name": F.min(F.when(loose, F.struct("fila", line.alias("v")))).over(w)})
    rows = rows.withColumn("_addr2", F.min(F.when(loose & (F.col("fila") > F.col("_name.fila")) & line.rlike(
        LOOKS_LIKE_ADDRESS), F.struct("fila", line.alias("v")))).over(w)["v"])
    body = rows.filter((F.col("fila") > F.col("_head")) & (F.size("celdas") >= 2))
    cell = lambda f: F.coalesce(F.get("celdas", (F.array_position("_map", f) - 1).cast("int")), F.lit(""))
    room, address = F.coalesce("_name.v", F.lit("")), F.coalesce("_addr", "_addr2", F.lit(""))
    body = body.withColumns({"_t": cell("titulo"), "_room": room, "direccion": address, "horario": cell("horario"),
                             "dias": dates.parse_weekdays(cell("dias")), "publico": cell("publico"),
                             "_lugar": cell("lugar"), "_com": cell("comuna")})
    generic = F.col("_t").rlike(GENERIC_TITLE)
    title = F.when(generic & (F.col("_room") != ""), F.concat(F.initcap("_room"), F.lit(" ("), F.col("_t"), F.lit(")"))
                   ).when(~generic, F.col("_t"))
    body = body.filter((F.col("_t") != "") & ~F.col("_t").rlike(IGNORED_ROW) & (F.size("dias") > 0))
    body = body.withColumns({"titulo": title, "_hhmm": dates.parse_time(F.col("horario"))}).filter("titulo is not null")
    cadence = dates.cadence_phrase(F.col("dias"), F.col("_hhmm"))
    detail = F.concat_ws(", ", cadence, F.when((F.col("horario") != "") & F.col("_hhmm").isNull(), F.concat(
        F.lit("horario "), F.col("horario"))), F.when(F.col("publico") != "", F.col("publico")))
    place = F.when(F.col("_lugar") != "", F.col("_lugar")).otherwise(F.col("_room"))
    body = body.withColumns({"_detail": detail, "_place": place, "_p": parse_price_clp(F.array_join("celdas", " "))})
    none = F.lit(None).cast("date")
    return as_candidates(body.select("*", F.posexplode(dates.future_sessions(
        F.col("dias"), F.col("_hhmm"), none, none, as_of, horizon)).alias("k", "inicio")).select(
        order_number(F.col("captura"), nested(F.col("tabla"), F.col("fila")), F.col("k")).alias("seq"), "titulo",
        F.lit(category).alias("categoria"), F.col("_detail").alias("descripcion_corta"), "inicio",
        F.when(F.col("_place") != "", F.col("_place")).otherwise(F.lit(src.source)).alias("lugar_nombre"),
        F.col("direccion").alias("lugar_direccion"),
        detect_area(F.lit(src.area), F.col("_com"), F.col("direccion"), F.col("_place")).alias("comuna"),
        F.col("_p.price").alias("precio_clp"), F.col("_p.free").alias("es_gratis"), F.col("_p.note").alias("precio_texto"),
        F.lit("tabla").alias("fuente_tipo"), F.lit(src.source).alias("fuente_nombre"),
        F.coalesce(F.when(F.lit(src.agenda_url) != "", F.lit(src.agenda_url)), F.col("url")).alias("fuente_url")))
