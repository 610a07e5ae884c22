"""Areas, distances and address text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kermesse.functions.text import (WORD_END, WORD_START, fold_py, fold_text, key_part, let,
                                     sql_text, squeeze, str_array, str_map)
from kermesse.vocab import places as v


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Flat-earth distance good enough inside the region."""
    dy = (lat1 - lat2) * F.lit(v.KM_PER_DEGREE_LAT)
    dx = (lon1 - lon2) * F.lit(v.KM_PER_DEGREE_LON)
    return F.sqrt(dy * dy + dx * dx)


def in_bbox(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Strictly inside the box; NULL coordinates are outside."""
    lat0, lat1, lon0, lon1 = box
    return F.coalesce((lat > lat0) & (lat < lat1) & (lon > lon0) & (lon < lon1), F.lit(False))


def coerce_coordinate(raw: Column, low: float, high: float) -> Column:
    """Decimal comma or point, range checked; anything else is NULL."""
    text = F.replace(F.trim(raw.cast("string")), F.lit(","), F.lit("."))
    num = F.when(text.rlike(r"^[+-]?\d+(\.\d*)?([eE][+-]?\d+)?$"), text.try_cast("double"))
    return F.when(num.between(low, high), num)


def coord_in_country(raw: Column, axis: str) -> Column:
    """Latitude or longitude (``axis``) inside the continental country, else NULL."""
    low, high = {"lat": (-56.0, -17.0), "lon": (-76.0, -66.0)}[axis]
    num = F.trim(raw.cast("string")).try_cast("double")
    return F.when((num > low) & (num < high), num)


def detect_area(*texts: Column) -> Column:
    """First text that mentions an area decides; within a text the list order does."""
    folded = [fold_py(a) for a in v.DETECTED_AREAS]
    pattern = f"{WORD_START}({'|'.join(folded)}){WORD_END}"
    names = str_array(v.DETECTED_AREAS)
    keys = str_array(folded)

    def first_of(text: Column) -> Column:
        found = F.regexp_extract_all(fold_text(text), F.lit(pattern), 1)
        best = F.array_min(F.transform(found, lambda m: F.array_position(keys, m)))
        return F.get(names, (best - 1).cast("int"))

    return F.coalesce(*[first_of(t) for t in texts], F.lit(""))


def normalise_street(text: Column) -> Column:
    """Folded street words with abbreviations and number words spelt as in the catalogue."""
    flat = squeeze(F.regexp_replace(fold_text(text), "[^a-z0-9ñ ]", " "))
    words = str_map(v.STREET_TOKENS)
    return F.array_join(F.transform(F.split(flat, " "), lambda w: F.coalesce(
        F.try_element_at(words, w), w)), " ")


def address_candidates(text: Column, digits: int = 5) -> Column:
    """``array<struct(street, number)>`` of a free address, best first.

    Each number of up to ``digits`` digits (nine at most) with text before it is a cut; numbers with a leading zero are
    another stretch of the street and are skipped. The number that closes the text comes
    first, then the longer street.
    """
    head = F.array_join(F.split(F.coalesce(text, F.lit("")), ","), " , ")
    flat = F.regexp_replace(normalise_street(head), r"\b(n|no|numero)\s+(\d)", "$2")
    flat = F.regexp_replace(flat, r"\b(ubicad[oa] en|ubicado|direccion)\b", " ")

    def cuts(s: Column) -> Column:
        marked = F.split(F.regexp_replace(s, rf"\b(\d{{1,{digits}}})\b", "\u0001$1\u0002"), "\u0001")

        def scan(parts: Column) -> Column:
            def one(part: Column, i: Column) -> Column:
                num = F.substring_index(part, "\u0002", 1)
                street = F.trim(F.replace(F.array_join(F.slice(parts, 1, i + 1), ""),
                                          F.lit("\u0002"), F.lit("")))
                closes = (i + 2 == F.size(parts)) & part.endswith("\u0002")
                return F.struct((~closes).alias("inner"), (-F.length(street)).alias("len"),
                                i.alias("pos"), street.alias("street"),
                                num.alias("num"))
            tail = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
            good = F.filter(F.transform(tail, one), lambda c: (c["street"] != "")
                            & ~c["num"].rlike(r"^0\d"))
            return F.transform(F.array_sort(good), lambda c: F.struct(
                c["street"].alias("street"), c["num"].cast("int").alias("number")))
        return let(marked, scan)

    return let(flat, cuts)


def area_hint(address: Column) -> Column:
    """Area name written after the first comma of an address; centre-list order decides."""
    rest = normalise_street(F.array_join(F.slice(F.split(F.coalesce(address, F.lit("")), ","), 2,
                                                 1_000_000_000), " "))

    def pick(s: Column) -> Column:
        names = F.expr("array(" + ", ".join(
            f"named_struct('name', {sql_text(a)}, 'key', {sql_text(fold_py(a))})" for a in v.AREA_CENTRES) + ")")
        return F.get(F.filter(names, lambda n: F.contains(s, n["key"])), F.lit(0))["name"]
    return F.coalesce(let(rest, pick), F.lit(""))


def area_centre(area: Column) -> Column:
    """``struct(lat, lon)`` of an area, or NULL."""
    centres = F.expr("map(" + ", ".join(
        f"{sql_text(k)}, named_struct('lat', {la}D, 'lon', {lo}D)" for k, (la, lo) in v.AREA_CENTRES.items()) + ")")
    return F.try_element_at(centres, area)


def nearest_area(lat: Column, lon: Column, city: Column, max_km: float = 6.0) -> Column:
    """The declared city if it is a known area, else the nearest centre within reach."""
    rows = F.expr("array(" + ", ".join(
        f"named_struct('name', {sql_text(a)}, 'key', {sql_text(fold_py(a))}, 'lat', {la}D, 'lon', {lo}D)"
        for a, (la, lo) in v.AREA_CENTRES.items()) + ")")
    declared = let(normalise_street(city), lambda c: F.get(
        F.filter(rows, lambda r: r["key"] == c), F.lit(0))["name"])
    near = F.array_min(F.transform(rows, lambda r, i: F.struct(
        planar_km(lat, lon, r["lat"], r["lon"]).alias("km"), i.alias("i"),
        r["name"].alias("name"))))
    return F.coalesce(declared, F.when(near["km"] < max_km, near["name"]), F.lit(""))


def match_known_venue(place: Column, area: Column) -> Column:
    """``struct(name, lat, lon)`` of the first known venue contained in the place name.

    A venue further than 8 km from the centre of the declared area is not it.
    """
    rows = F.expr("array(" + ", ".join(
        f"named_struct('name', {sql_text(n)}, 'lat', {la}D, 'lon', {lo}D)" for n, (la, lo) in v.KNOWN_VENUES.items()) + ")")

    def pick(key: Column, centre: Column) -> Column:
        far = lambda r: F.coalesce(
            planar_km(r["lat"], r["lon"], centre["lat"], centre["lon"]) > 8, F.lit(False))
        return F.get(F.filter(rows, lambda r: F.contains(key, r["name"]) & ~far(r)), F.lit(0))

    both = F.struct(fold_text(place, "squeeze").alias("k"), area_centre(area).alias("c"))
    return let(both, lambda b: pick(b["k"], b["c"]))


def normalise_region(raw: Column) -> Column:
    """Canonical region name from the spellings of the offer sources."""
    clean = fold_text(raw)
    for noise in ("region de ", "region del ", "region "):
        clean = F.replace(clean, F.lit(noise), F.lit(""))

    def name(s: Column) -> Column:
        return (F.when(s == "", F.lit(""))
                .when(s.isin("rm", "r.m.", "r m") | s.startswith("metropol"), F.lit("Metropolitana"))
                .otherwise(F.coalesce(F.try_element_at(str_map(v.REGIONS), s), F.trim(raw))))
    return let(F.trim(clean), name)


def region_list(regions: Column) -> Column:
    """One label for a list of regions; more than three means nation-wide."""
    bare = F.transform(regions, lambda r: F.trim(F.replace(F.regexp_replace(
        r, "Región de |Región del |Región ", ""), F.lit(" de Santiago"), F.lit(""))))
    return (F.when(F.coalesce(F.size(regions), F.lit(0)) <= 0, F.lit(""))
            .when(F.size(regions) > 3, F.lit("Todo Chile"))
            .otherwise(F.array_join(bare, " · ")))


def offer_areas() -> Column:
    """Map of folded area spelling to display name; one area shares its name with a region."""
    pairs = {fold_py(a): a for a in v.OFFER_AREAS}
    pairs["coquimbo ciudad"] = "Coquimbo"
    return str_map(pairs)


def place_from_tags(tags: Column) -> Column:
    """``struct(area, region)`` out of a flat list of tags."""
    from kermesse.vocab.offers import TAG_NOISE
    flat = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: fold_text(t))

    def read(ts: Column) -> Column:
        regions, areas = str_map(v.REGIONS), offer_areas()
        region_tag = F.get(F.filter(ts, lambda t: F.try_element_at(regions, t).isNotNull()), F.lit(0))
        area_tag = F.get(F.filter(ts, lambda t: F.coalesce(t != region_tag, F.lit(True))
                                  & ~t.isin(*TAG_NOISE)
                                  & F.try_element_at(areas, t).isNotNull()), F.lit(0))
        return F.struct(
            F.coalesce(F.try_element_at(areas, area_tag), F.try_element_at(areas, region_tag),
                       F.lit("")).alias("area"),
            F.coalesce(F.try_element_at(regions, region_tag), F.lit("")).alias("region"))
    return let(flat, read)


def parse_branches(html: Column) -> Column:
    """``array<struct(address, region, area)>`` from ``;``-separated list items."""
    items = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?s)<li[^>]*>(.*?)</li>"), 1)
    cells = F.transform(items, lambda i: F.transform(
        F.split(F.regexp_replace(i, "<[^>]+>", " "), ";"),
        lambda p: F.when(F.upper(F.trim(p)) == "VACIO", F.lit("")).otherwise(F.trim(p))))
    full = F.filter(cells, lambda c: (F.size(c) >= 4) & (
        (F.get(c, F.lit(1)) != "") | (F.get(c, F.lit(3)) != "")))
    return F.transform(full, lambda c: F.struct(
        squeeze(F.get(c, F.lit(1))).alias("address"),
        normalise_region(F.get(c, F.lit(2))).alias("region"),
        F.coalesce(F.try_element_at(offer_areas(), fold_text(F.get(c, F.lit(3)))),
                   F.initcap(F.get(c, F.lit(3)))).alias("area")))


def offer_html_fields(html: Column) -> Column:
    """``struct(address, area, phone, site)`` from the classed items of a promotion."""
    raw = F.coalesce(html, F.lit(""))
    block = F.regexp_extract(raw, r'(?s)class="direccion"[^>]*>(.*?)</li>', 1)
    lines = F.filter(F.transform(
        F.split(F.regexp_replace(block, r"(?s)<i[^>]*>.*?</i>", " "), r"<br\s*/?>"),
        lambda t: squeeze(F.regexp_replace(t, "<[^>]+>", " "))), lambda t: t != "")
    known = F.filter(F.transform(F.reverse(F.slice(lines, 2, 1_000_000_000)),
                                 lambda t: F.try_element_at(offer_areas(), fold_text(t))),
                     lambda a: a.isNotNull())
    phone = F.regexp_extract(raw, r'(?s)class="telefono"[^>]*>(.*?)</li>', 1)
    site = F.regexp_extract(raw, r'(?s)class="web"[^>]*>\s*<a[^>]*href="([^"]+)"', 1)
    return F.struct(F.coalesce(F.get(lines, F.lit(0)), F.lit("")).alias("address"),
                    F.coalesce(F.get(known, F.lit(0)), F.lit("")).alias("area"),
                    squeeze(F.regexp_replace(phone, "<[^>]+>", " ")).alias("phone"),
                    F.trim(site).alias("site"))


def in_sector(area: Column, sector: str) -> Column:
    return F.lit(True) if sector == "todo" else F.coalesce(area, F.lit("")).isin(
        *v.SECTORS.get(sector, ()))


def sector_of(area: Column) -> Column:
    """The sector an area lies in, NULL for none."""
    out = F.lit(None).cast("string")
    for name, areas in v.SECTORS.items():
        out = F.when(area.isin(*areas), F.lit(name)).otherwise(out)
    return out


def merchant_key(name: Column) -> Column:
    """Merchant name as compared between issuers."""
    return key_part(name)

