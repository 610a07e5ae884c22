"""Tiered geocoding as equi-joins against an address and a place catalogue.

Every tier works on the distinct queries, never on the rows that carry them, and only on those that no stricter tier has
settled.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.functions.places import (address_candidates, area_centre, area_hint, match_known_venue,
                                       nearest_area, normalise_street, planar_km)
from kermesse.functions.text import fold_text
from kermesse.operators.skew import best_row, lookup
from kermesse.schemas import RESOLUTION
from kermesse.session import ensure_checkpoint_dir, stage
from kermesse.vocab import places as v

NEAR_NUMBER = 250
TIGHT_KM, WIDE_KM = 4.5, 8.0


def pick_candidate(found: DataFrame, keys: list[str], radius_km: float) -> DataFrame:
    """One point per key: same city, else nearest to the area centre, else a tight cluster.

    ``found``: keys, comuna, ciudad, lat, lon, orden (catalogue order). Keys without an
    acceptable point produce no row. All parts are map-side combined.
    """
    area = normalise_street(F.col("comuna"))
    rows = found.withColumns({"_area": area, "_c": area_centre(F.col("comuna"))})
    point = F.struct(F.col("lat"), F.col("lon"))
    first = F.struct("orden", point.alias("p"))
    km = planar_km(F.col("lat"), F.col("lon"), F.col("_c.lat"), F.col("_c.lon"))
    agg = rows.groupBy(*keys).agg(
        F.max("_area").alias("area"), F.max(F.col("_c").isNotNull()).alias("known"),
        F.min(F.when((F.col("ciudad") == F.col("_area")) & (F.col("_area") != ""), first))["p"].alias("same"),
        F.min(F.struct(km.alias("km"), F.col("orden"), point.alias("p"))).alias("near"),
        F.min(first)["p"].alias("any"),
        ((F.max("lat") - F.min("lat")) * v.KM_PER_DEGREE_LAT).alias("dy"),
        ((F.max("lon") - F.min("lon")) * v.KM_PER_DEGREE_LON).alias("dx"))
    tight = (F.col("dy") < 2) & (F.col("dx") < 2)
    best = (F.when(F.col("same").isNotNull(), F.col("same"))
            .when((F.col("area") != "") & F.col("known"),
                  F.when(F.col("near.km") < radius_km, F.col("near.p")))
            .when(tight, F.col("any")))
    return agg.select(*keys, best.alias("_p")).filter("_p is not null").select(*keys, "_p.*")


def number_catalogue(addresses: DataFrame) -> DataFrame:
    """Catalogue with a stable order column (street order of the table, made explicit)."""
    if "orden" in addresses.columns:
        return addresses
    return addresses.withColumn("orden", F.struct("ciudad", "lat", "lon"))


def _candidates(queries: DataFrame, digits: int = 5) -> DataFrame:
    """qid, comuna, cand, cut, words left, number: every suffix of every candidate street."""
    area = F.when(F.coalesce(F.col("comuna"), F.lit("")) != "", F.col("comuna")).otherwise(
        area_hint(F.col("direccion")))
    base = queries.filter(F.coalesce(F.col("direccion"), F.lit("")) != "").select(
        "qid", area.alias("comuna"),
        F.posexplode_outer(address_candidates(F.col("direccion"), digits)).alias("cand", "c")
    ).filter("c is not null")
    words = F.split(F.col("c.street"), " ")
    cuts = base.select("qid", "comuna", "cand", F.col("c.number").alias("numero"), words.alias("_w"),
                       F.explode(F.sequence(F.lit(0), F.size(words) - 1)).alias("cut"))
    return cuts.select("qid", "comuna", "cand", "cut", "numero", F.array_join(
        F.slice("_w", F.col("cut") + 1, F.size("_w")), " ").alias("calle_q"))


def street_spans(addresses: DataFrame) -> DataFrame:
    """Catalogue rows under every word span of their street: ``kind`` 0 whole, 1 head, 2 tail, 3 middle.

    Turns exact, prefix, suffix and infix street matches into equi-joins on the span and the hundred-block ``tramo`` of
    the house number.
    """
    words = F.split("calle", " ")
    n = F.size(words)
    spans = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(
        F.sequence(i + 1, n), lambda j: F.struct(
            F.array_join(F.slice(words, i + 1, j - i), " ").alias("calle_q"),
            F.when((i == 0) & (j == n), 0).when(i == 0, 1).when(j == n, 2).otherwise(3).alias("kind")))))
    return number_catalogue(addresses).withColumn("_s", F.explode(F.array_distinct(spans))).select(
        "_s.*", _block(F.col("numero")).alias("tramo"), F.col("numero").alias("numero_c"), "ciudad", "lat", "lon", "orden")


def _block(number: Column) -> Column:
    return F.floor(number / NEAR_NUMBER).cast("int")


@dataclass(frozen=True)
class Catalogue:
    """What the tiers look up: street spans and named places; ``digits`` is how long its house numbers get."""

    spans: DataFrame
    places: DataFrame
    digits: int = 5


def catalogue_of(addresses: DataFrame, places: DataFrame, digits: int = 5) -> Catalogue:
    """Both catalogues as they are, for one use; :func:`write_catalogue` keeps them for many."""
    return Catalogue(street_spans(addresses), places, digits)


def write_catalogue(addresses: DataFrame, places: DataFrame, name: str | None = None, buckets: int | None = None,
                    digits: int = 5) -> Catalogue:
    """Write both catalogues as tables bucketed and sorted by what the tiers look up, and read them back.

    Spans are built once, in a folder a kind: exact matches, the most frequent, read whole streets alone. The tiers' joins
    read the buckets as they lie: only queries are shuffled, never a catalogue.
    """
    spark = addresses.sparkSession
    name = name or f"catalogo_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = f"{ensure_checkpoint_dir(spark)}/{name}"
    for part, rows, keys, folders in (("tramos", street_spans(addresses), ("calle_q", "tramo"), ("kind",)), ("locales", places, ("nombre",), ())):
        (rows.repartition(buckets, *keys).write.mode("overwrite").option("path", f"{root}/{part}").partitionBy(*folders)
         .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"{name}_{part}"))
    return read_catalogue(spark, name, digits)


def read_catalogue(spark: SparkSession, name: str, digits: int = 5) -> Catalogue:
    return Catalogue(spark.table(f"{name}_tramos"), spark.table(f"{name}_locales"), digits)


def _met(cands: DataFrame, spans: DataFrame, near: bool = False) -> DataFrame:
    """Candidates beside the catalogue rows of their span and block, with the ``gap`` between the numbers."""
    own = _block(F.col("numero"))
    probe = cands.withColumn("tramo", F.explode(F.array(own - 1, own, own + 1)) if near else own)
    return probe.join(spans, ["calle_q", "tramo"]).withColumn("gap", F.abs(F.col("numero_c") - F.col("numero")))


def exact_matches(cands: DataFrame, spans: DataFrame) -> DataFrame:
    return pick_candidate(_met(cands, spans.filter("kind = 0")).filter("gap = 0"), ["qid", "cand", "cut"], WIDE_KM)


def partial_matches(cands: DataFrame, spans: DataFrame) -> DataFrame:
    """Shortened street names: same number, at least six characters."""
    hits = _met(cands.filter(F.length("calle_q") >= 6), spans.filter("kind > 0")).filter("gap = 0")
    return pick_candidate(hits, ["qid", "cand", "cut", "kind"], TIGHT_KM)


def near_matches(cands: DataFrame, spans: DataFrame) -> DataFrame:
    """Numbers near on the street, nearest first, by a bucketed range join."""
    hits = _met(cands, spans, near=True).filter(
        (F.col("gap") < NEAR_NUMBER) & ((F.col("kind") == 0) | (F.length("calle_q") >= 6)))
    return pick_candidate(hits.withColumn("orden", F.struct("gap", "orden")), ["qid", "cand", "cut", "kind"], TIGHT_KM)


def _rank(tier: int, kind: Column) -> Column:
    return F.struct(F.col("cand").alias("a"), F.lit(tier).alias("b"), F.col("cut").alias("c"), kind.alias("d"),
                    F.col("lat"), F.col("lon"))


def _open(cands: DataFrame, best: DataFrame) -> DataFrame:
    """Candidates that come before the one that is settled, or all where none is."""
    return cands.join(best.select("qid", F.col("r.a").alias("_a")), "qid", "left").filter(
        F.col("_a").isNull() | (F.col("cand") < F.col("_a"))).drop("_a")


def strict_addresses(queries: DataFrame, spans: DataFrame, digits: int = 5) -> DataFrame:
    """qid, lat, lon by street and number alone."""
    exact = exact_matches(_candidates(queries, digits), spans)
    return exact.groupBy("qid").agg(F.min(_rank(0, F.lit(0))).alias("s")).select("qid", "s.lat", "s.lon")


def loose_addresses(queries: DataFrame, spans: DataFrame, strict: bool = True, digits: int = 5) -> DataFrame:
    """qid, lat, lon, tier: a candidate is relaxed before the next one is tried.

    Each looser match only sees candidates that could still win. ``strict=False`` leaves the exact match out, where it is
    known that none of the queries has one.
    """
    cands = stage(_candidates(queries, digits))
    best = None
    if strict:
        best = stage(exact_matches(cands, spans).groupBy("qid").agg(F.min(_rank(0, F.lit(0))).alias("r")))
    waiting = cands if best is None else _open(cands, best)
    partial = stage(partial_matches(waiting, spans).groupBy("qid").agg(F.min(_rank(1, F.col("kind"))).alias("r")))
    best = partial if best is None else best.unionByName(partial).groupBy("qid").agg(F.min("r").alias("r"))
    near = near_matches(_open(cands, best), spans).select("qid", _rank(2, F.col("kind")).alias("r"))
    every = best.unionByName(near).groupBy("qid").agg(F.min("r").alias("r"))
    tier = F.element_at(F.array(F.lit("exacta"), F.lit("parcial"), F.lit("cercana")), F.col("r.b") + 1)
    return every.select("qid", "r.lat", "r.lon", tier.alias("tier"))


def resolve_places(queries: DataFrame, places: DataFrame) -> DataFrame:
    """qid, lat, lon by exact place name of at least six characters and two words."""
    key = normalise_street(F.col("lugar"))
    named = queries.select("qid", "comuna", key.alias("nombre")).filter(
        (F.length("nombre") >= 6) & (F.size(F.split("nombre", " ")) >= 2))
    catalogue = places.select("nombre", "lat", "lon", F.lit("").alias("ciudad"),
                              F.struct("lat", "lon").alias("orden"))
    return pick_candidate(named.join(catalogue, "nombre"), ["qid"], WIDE_KM)


def query_text(address: Column, place: Column, area: Column) -> Column:
    """Folded text under which earlier resolutions are stored."""
    what = F.when(F.coalesce(address, F.lit("")) != "", address).otherwise(place)
    return fold_text(F.concat_ws(", ", *[F.when(c != "", c) for c in (what, area)],
                                 F.lit("Santiago, Chile")), "squeeze")


def reuse_resolutions(queries: DataFrame, prior: DataFrame) -> DataFrame:
    """qid, lat, lon from ``prior(consulta, lat, lon)``; stored failures are ignored."""
    known = best_row(prior.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("consulta", "lat", "lon"),
                     ["consulta"], [F.col("lat"), F.col("lon")])
    asked = queries.withColumn("consulta", query_text(F.col("direccion"), F.col("lugar"), F.col("comuna")))
    return asked.join(known, "consulta").select("qid", "lat", "lon")


def distinct_queries(df: DataFrame) -> DataFrame:
    """One row per place, address and area, with a hashed ``qid``."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return df.select(text("lugar"), text("direccion"), text("comuna")).distinct().withColumn(
        "qid", F.sha2(F.concat_ws("\u0001", "lugar", "direccion", "comuna"), 256))


def geocode_queries(queries: DataFrame, catalogue: Catalogue, prior: DataFrame | None = None,
                    seen: dict[str, DataFrame] | None = None) -> DataFrame:
    """qid, lat, lon, precision for ``queries(qid, lugar, direccion, comuna)``.

    From the strictest tier to the loosest; each sees the queries that none before it has settled. ``seen`` is filled
    with the queries that enter each tier.
    """
    waiting = stage(queries.select("qid", "lugar", "direccion", "comuna"))
    settled = []

    def settle(name: str, tier, label: str) -> None:
        nonlocal waiting
        if seen is not None:
            seen[name] = waiting
        found = stage(tier(waiting).select("qid", "lat", "lon", F.lit(label).alias("precision")))
        settled.append(found)
        waiting = waiting.join(found.select("qid"), "qid", "left_anti")

    settle("exacta", lambda q: strict_addresses(q, catalogue.spans, catalogue.digits), "calle")
    venue = match_known_venue(F.col("lugar"), F.col("comuna"))
    settle("recinto", lambda q: q.select("qid", venue.alias("_v")).filter("_v is not null").select("qid", "_v.lat", "_v.lon"), "recinto")
    if prior is not None:
        settle("previa", lambda q: reuse_resolutions(q, prior), "calle")
    settle("direccion", lambda q: loose_addresses(q, catalogue.spans, strict=False, digits=catalogue.digits), "calle")
    settle("lugar", lambda q: loose_addresses(q.select("qid", F.col("lugar").alias("direccion"), "comuna"), catalogue.spans, digits=catalogue.digits), "calle")
    settle("local", lambda q: resolve_places(q, catalogue.places), "recinto")
    if seen is not None:
        seen["centro"] = waiting
    centre = area_centre(F.col("comuna"))
    rest = waiting.select("qid", centre.alias("_c")).select(
        "qid", "_c.lat", "_c.lon", F.when(F.col("_c").isNotNull(), "comuna").otherwise("").alias("precision"))
    for found in settled:
        rest = rest.unionByName(found)
    return rest


# -- earlier resolutions ----------------------------------------------------------------------

def read_resolutions(spark: SparkSession, path: str) -> DataFrame:
    """The newest outcome of every query that was ever asked; a failure has no point."""
    try:
        every = spark.read.schema(RESOLUTION).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        every = spark.createDataFrame([], RESOLUTION)
    return best_row(every, ["qid"], [F.col("resuelto"), F.col("corrida")], largest=True)


def geocode_remembered(queries: DataFrame, catalogue: Catalogue, path: str, now: Column, days: int = 30,
                       prior: DataFrame | None = None) -> DataFrame:
    """qid, lat, lon, precision, nueva: asks only what the table at ``path`` does not answer, and writes what it found.

    Points stay known; a query without a point, or with the area's centre only, is asked again after ``days``. Each run
    appends its outcomes, failures too, to the partition of its day; the newest outcome of a query counts.
    """
    known = read_resolutions(queries.sparkSession, path)
    firm = F.col("lat").isNotNull() & (F.col("precision") != "comuna")
    fresh = F.datediff(now.cast("date"), F.col("dia")) < days
    answered = stage(queries.select("qid").join(known.filter(firm | fresh), "qid").select("qid", "lat", "lon", "precision"))
    asked = stage(queries.join(answered.select("qid"), "qid", "left_anti"))
    found = stage(geocode_queries(asked, catalogue, prior))
    run = F.lit(uuid.uuid4().hex)
    (asked.join(found, "qid").select("qid", "lugar", "direccion", "comuna", "lat", "lon", "precision",
                                     now.cast("timestamp_ntz").alias("resuelto"), run.alias("corrida"), now.cast("date").alias("dia"))
     .write.mode("append").partitionBy("dia").parquet(path))
    return answered.withColumn("nueva", F.lit(False)).unionByName(found.withColumn("nueva", F.lit(True)))


def geocode(df: DataFrame, catalogue: Catalogue, prior: DataFrame | None = None, remembered: str | None = None,
            now: Column | None = None) -> DataFrame:
    """Fill lat, lon and precision of rows without a pin; others are left as they are.

    With ``remembered`` and ``now``, outcomes are kept in that table from run to run.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    need = df.filter(F.col("lat").isNull()).withColumn(
        "qid", F.sha2(F.concat_ws("\u0001", text("lugar"), text("direccion"), text("comuna")), 256))
    queries = distinct_queries(df.filter(F.col("lat").isNull()))
    answers = (geocode_queries(queries, catalogue, prior) if remembered is None
               else geocode_remembered(queries, catalogue, remembered, now, prior=prior))
    got = lookup(need, answers.select("qid", F.col("lat").alias("_la"), F.col("lon").alias("_lo"),
                                      F.col("precision").alias("_p")), ["qid"])
    filled = got.withColumns({"lat": F.col("_la"), "lon": F.col("_lo"), "precision": F.when(
        F.col("_la").isNull(), "sin_ubicar").otherwise(F.col("_p"))})
    return filled.select(*df.columns).unionByName(df.filter(F.col("lat").isNotNull()))


def override_contradicting_coords(df: DataFrame, spans: DataFrame, km: float = 1.0, digits: int = 5) -> DataFrame:
    """Where the row's own address resolves further than ``km`` from its pin, the address wins."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    both = F.col("lat").isNotNull() & (text("direccion") != "")
    keyed = df.withColumn("qid", F.when(both, F.sha2(F.concat_ws(
        "\u0001", text("direccion"), text("comuna")), 256)))
    queries = keyed.filter(both).select("qid", "direccion", "comuna").dropDuplicates(["qid"])
    real = loose_addresses(queries, spans, digits=digits).select("qid", F.col("lat").alias("_la"), F.col("lon").alias("_lo"))
    out = lookup(keyed, real, ["qid"])
    far = F.coalesce(planar_km(F.col("lat"), F.col("lon"), F.col("_la"), F.col("_lo")) > km, F.lit(False))
    return out.withColumns({
        "lat": F.when(far, F.col("_la")).otherwise(F.col("lat")),
        "lon": F.when(far, F.col("_lo")).otherwise(F.col("lon")),
        "precision": F.when(far, "calle").otherwise(F.col("precision"))}).select(*df.columns)


def match_unambiguous_place(merchants: DataFrame, places: DataFrame) -> DataFrame:
    """A merchant's place when the catalogue leaves no doubt, else the reason it does."""
    la0, la1, lo0, lo1 = v.BOX_REGION
    food = places.filter(F.col("tipo").isin(*v.FOOD_PLACE_TYPES)).withColumn(
        "clave", F.col("nombre"))
    stats = food.groupBy("clave").agg(
        F.count(F.lit(1)).alias("n"),
        ((F.max("lat") - F.min("lat")) * v.KM_PER_DEGREE_LAT).alias("dy"),
        ((F.max("lon") - F.min("lon")) * v.KM_PER_DEGREE_LON).alias("dx"),
        F.min(F.struct("lat", "lon", "tipo", "direccion", "ciudad")).alias("p"))
    asked = merchants.select("comercio", F.coalesce("comuna", F.lit("")).alias("comuna"),
                             normalise_street(F.col("comercio")).alias("clave"))
    got = asked.join(stats, "clave", "left")
    centre = area_centre(F.col("comuna"))
    far = planar_km(F.col("p.lat"), F.col("p.lon"), centre["lat"], centre["lon"]) >= 7
    zone = F.when(F.col("comuna") != "", F.col("comuna")).otherwise(
        nearest_area(F.col("p.lat"), F.col("p.lon"), F.col("p.ciudad")))
    inside = F.col("p.lat").between(la0, la1) & F.col("p.lon").between(lo0, lo1)
    reason = (F.when(F.length("clave") < 4, "nombre muy corto")
              .when(F.col("clave").isin(*v.GENERIC_MERCHANTS), "nombre generico")
              .when(F.col("n").isNull(), "no esta en el catalogo")
              .when((F.col("dy") > 1.5) | (F.col("dx") > 1.5), "cadena")
              .when(F.coalesce(far, F.lit(False)), "lejos de la comuna")
              .when(~inside, "fuera de la region")
              .when(zone == "", "sin comuna").otherwise("ok"))
    ok = F.col("motivo") == "ok"
    out = got.withColumns({"motivo": reason, "_zona": zone})
    return out.select("comercio", "motivo", *[F.when(ok, e).alias(n) for n, e in (
        ("direccion", F.col("p.direccion")), ("comuna", F.col("_zona")), ("lat", F.round("p.lat", 5)),
        ("lon", F.round("p.lon", 5)), ("tipo", F.col("p.tipo")),
        ("confianza", F.when(F.coalesce("p.direccion", F.lit("")) != "", "alta").otherwise("media")))])
