"""Geocoding: tiers see only what is open, catalogues are not moved, outcomes are remembered."""

import pytest
from pyspark.sql import functions as F

from kermesse.operators import geocode as g

STREETS = [("avenida las torres", 840, "macul", -33.48, -70.60), ("juan moya morales", 1370, "nunoa", -33.46, -70.58),
           ("avenida vicuna mackenna", 7100, "la florida", -33.52, -70.60), ("los alerces", 10, "", -33.4, -70.6)]
PLACES = [("bar de rene", "bar", -33.44, -70.63, "", "santiago")]
QUERIES = [
    ("q1", "", "Av. Las Torres 840", ""),  # exact
    ("q2", "Sala Matucana 100", "", ""),  # known venue
    ("q3", "", "Previa 9", ""),  # answered before
    ("q4", "", "Juan Moya 1370", ""),  # shortened street
    ("q5", "", "Avenida Vicuña Mackenna 7110", ""),  # near number
    ("q6", "JJ. VV. Simón Bolívar Av. Las Torres # 840", "", ""),  # address inside the name
    ("q7", "Bar de René", "", ""),  # named place
    ("q8", "Otro", "", "Macul"),  # centre of the area
    ("q9", "Otro", "", ""),  # none
]


@pytest.fixture(scope="module")
def tables(spark):
    addresses = spark.createDataFrame(STREETS, "calle string, numero int, ciudad string, lat double, lon double")
    places = spark.createDataFrame(PLACES, "nombre string, tipo string, lat double, lon double, direccion string, ciudad string")
    return addresses, places


@pytest.fixture(scope="module")
def catalogue(tables):
    return g.write_catalogue(*tables)


def asked(spark):
    return spark.createDataFrame(QUERIES, "qid string, lugar string, direccion string, comuna string")


def prior(spark):
    return spark.createDataFrame([("previa 9, santiago, chile", -33.3, -70.7)], "consulta string, lat double, lon double")


WANT = {"q1": (-33.48, "calle"), "q2": (-33.4436, "recinto"), "q3": (-33.3, "calle"), "q4": (-33.46, "calle"), "q5": (-33.52, "calle"),
        "q6": (-33.48, "calle"), "q7": (-33.44, "recinto"), "q8": (-33.489, "comuna"), "q9": (None, "")}


def test_each_tier_sees_what_is_open(spark, catalogue):
    seen = {}
    out = g.geocode_queries(asked(spark), catalogue, prior(spark), seen)
    assert {r.qid: (r.lat and round(r.lat, 4), r.precision) for r in out.collect()} == WANT
    entered = {k: sorted(r.qid for r in v.select("qid").collect()) for k, v in seen.items()}
    ids = [q[0] for q in QUERIES]
    assert entered == {"exacta": ids, "recinto": ids[1:], "previa": ids[2:], "direccion": ids[3:], "lugar": ids[5:],
                       "local": ids[6:], "centro": ids[7:]}


def test_unwritten_catalogue_gives_the_same(spark, tables):
    out = g.geocode_queries(asked(spark), g.catalogue_of(*tables), prior(spark))
    assert {r.qid: (r.lat and round(r.lat, 4), r.precision) for r in out.collect()} == WANT


def test_catalogues_are_not_moved(spark, catalogue):
    """Without broadcasts the tiers' joins shuffle the queries only."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cands = g._candidates(asked(spark))
        for df, key in ((g._met(cands, catalogue.spans), "calle_q"), (g._met(cands, catalogue.spans, near=True), "calle_q"),
                        (g.resolve_places(asked(spark), catalogue.places), "nombre")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Bucketed: true" in plan
            assert plan.count(f"Exchange hashpartitioning({key}") + plan.count(f"Exchange hashpartitioning(calle_q") * (key != "calle_q") == 1, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_outcomes_are_remembered(spark, catalogue, tmp_path):
    path = str(tmp_path / "resoluciones")
    run = lambda ids, day: {r.qid: (r.lat and round(r.lat, 4), r.precision, r.nueva) for r in g.geocode_remembered(
        asked(spark).filter(F.col("qid").isin(ids)), catalogue, path, F.lit(f"2024-01-{day:02d} 08:00:00").cast("timestamp_ntz"), days=10, prior=prior(spark)).collect()}
    ids = [q[0] for q in QUERIES]
    assert run(ids[:4], 1) == {i: (*WANT[i], True) for i in ids[:4]}
    assert run(ids, 2) == {i: (*WANT[i], i not in ids[:4]) for i in ids}  # nothing of the first run is asked again
    assert run(ids, 5) == {i: (*WANT[i], False) for i in ids}
    # Failures and area centres are asked again when they are old.
    assert {i for i, x in run(ids, 20).items() if x[2]} == {"q8", "q9"}
    days = [r.dia.day for r in spark.read.parquet(path).select("dia").distinct().orderBy("dia").collect()]
    assert days == [1, 2, 20]
