"""Steps that grew too fast with their input in the third round: what is costly is done once a page or once a row."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from kermesse.functions import dates, money
from kermesse.operators.collapse import collapse_multiday
from kermesse.schemas import CANDIDATE, conform
from kermesse.sources import html, json_items
from kermesse.streaming import jobs

AS_OF = F.lit("2024-01-15").cast("date")


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def captured(spark, *bodies):
    return spark.createDataFrame([("s", "https://x.cl", n, b) for n, b in enumerate(bodies)], "source_id string, url string, seq bigint, body string").repartition(2)


def test_f15_a_date_costs_one_search_a_pattern(spark):
    rows = spark.createDataFrame([("31/4 y 2/5 a las 19:30",), ("del 3 al 5 de abril, 9h05",), ("30 de febrero o 1 de marzo de 2024, a las 21 horas",), ("-",), (None,)], "t string")
    parsed = rows.select(dates.parse_date_es(F.col("t"), AS_OF).cast("string").alias("d"))
    assert [r.d for r in parsed.collect()] == ["2024-05-02 19:30:00", "2024-04-03 09:05:00", "2024-03-01 21:00:00", None, None]
    assert plan_of(parsed).count("regexp_extract(") <= 3


def test_f15_prices_read_as_before(spark):
    rows = spark.createDataFrame([("Entrada $5.000 o gratis",), ("vale 12.000 pesos",), ("$0",), ("freestyle $ 12 500",), ("nada",)], "t string")
    got = [tuple(r.p) for r in rows.select(money.parse_price_clp(F.col("t")).alias("p")).collect()]
    assert got == [(0, True, "Entrada $5.000 o gratis"), (12000, False, "vale 12.000 pesos"), (None, None, ""), (12500, False, "freestyle $ 12 500"), (None, None, "")]


def test_f25_structured_data_is_parsed_once(spark):
    page = '<script type="application/ld+json">{"@graph": [{"@type": "Event", "name": "a"}, {"@type": "x"}]}</script>'
    nodes = html.jsonld_nodes(captured(spark, page, "<p>", None)).select("captura", "n", json_items.raw_at(F.col("item"), "@type").alias("t"))
    assert plan_of(nodes).count("try_parse_json") + plan_of(nodes).count("parseJson") == 1
    assert sorted(map(tuple, nodes.collect())) == [(0, 0, "Event"), (0, 1, "x")]



def test_f19_rows_are_not_dealt_out_by_source(spark, sf):
    from kermesse.bindings import flagship
    from kermesse.bindings import inputs as i
    from kermesse.operators.filters import gate

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # what Spark assumes of tables too large to guess
    try:
        config = flagship._config(spark, sf)
        gated = gate(i.candidates(spark, sf), config, i.as_of())
        assert "hashpartitioning(fuente_nombre" not in gated._jdf.queryExecution().executedPlan().toString()
        assert gated.count() == i.candidates(spark, sf).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_f19_large_settings_are_looked_up_by_a_shuffle(spark, monkeypatch):
    from kermesse.operators import skew

    rows = spark.range(100).selectExpr("id", "id % 3 AS k")
    dim = spark.range(2).selectExpr("id AS k", "concat('v', id) AS v")
    want = sorted((r.id, r.k, None if r.k == 2 else f"v{r.k}") for r in rows.collect())
    for most in (0, skew.SETTINGS_CHARS):
        monkeypatch.setattr(skew, "SETTINGS_CHARS", most)
        assert sorted((r.id, r.k, r.v) for r in skew.lookup_settings(rows, dim, ["k"]).collect()) == want


def test_f17_signs_of_a_row_are_searched_once(spark, sf):
    from kermesse.bindings import inputs as i
    from kermesse.bindings import ranking
    from kermesse.functions import labels
    from kermesse.operators import recommend

    scored = recommend.score_pairs(ranking._prepared(spark, sf), recommend.profiles_of(spark, ranking.PROFILES), i.now())
    assert scored.columns[-3:] == ["para_ninos", "adulto", "titulo_base"]
    assert plan_of(scored).count(labels.ADULT_SIGNAL[:30]) == 1


def sessions(spark, *made):
    """Candidates of one series: seq, hours since 2024 began (None: undated)."""
    rows = [(s, None if h is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)) for s, h in made]
    df = spark.createDataFrame(rows, "seq long, inicio timestamp_ntz").withColumns({
        "titulo": F.lit("Obra"), "lugar_nombre": F.lit("Sala"), "precio_clp": F.when(F.col("seq") % 3 != 0, F.col("seq")),
        "imagen_url": F.when(F.col("seq") % 2 == 0, F.concat(F.lit("i"), "seq"))})
    return conform(df, CANDIDATE)


def seen(df):
    return sorted(map(str, df.collect()))


def test_f23_state_takes_partial_seasons(spark, tmp_path):
    """Six hundred rows of one series reach the Python processor as its two seasons."""
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    rows = sessions(spark, *[(n, n % 50 + 24 * 20 * (n % 2)) for n in range(600)], (600, None))
    rows.write.parquet(src)
    query = jobs.stream_collapse(spark.readStream.schema(rows.schema).parquet(src), out, ck, "60 days")
    query.awaitTermination()
    assert sum(p.numInputRows for p in query.recentProgress) == 2
    assert seen(jobs.read_seasons(spark, out, ck)) == seen(collapse_multiday(rows))


def test_f23_late_rows_stay_single_and_whole(spark, tmp_path):
    """Late by the lots before it, to the hour; a second stream that failed catches up with the lots of both runs."""
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    lots = [[(1, 0), (2, 30), (3, None)], [(4, 960), (5, 1)], [(6, 720), (7, 721), (8, 2), (9, 3), (10, None)]]
    for lot in lots:
        sessions(spark, *lot).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(sessions(spark).schema).option("maxFilesPerTrigger", 1).parquet(src)
    jobs.stream_partials(stream, out, f"{ck}/parciales", "10 days", 4).awaitTermination()
    sessions(spark, (11, 963), (12, 4)).coalesce(1).write.mode("append").parquet(src)
    jobs.stream_collapse(stream, out, ck, "10 days").awaitTermination()
    late = jobs.read_results(spark, out, "tarde")
    all_rows = sessions(spark, *sum(lots, []), (11, 963), (12, 4))
    assert seen(late.select("first.row.*")) == seen(all_rows.where("seq in (6, 8, 9, 12)"))
    assert late.where("n = 1 and desde = hasta and last.s = first.s").count() == 4
    assert seen(jobs.read_seasons(spark, out, ck)) == seen(collapse_multiday(all_rows.where("seq not in (6, 8, 9, 12)")))


@pytest.mark.parametrize("delay, ms", [("2 days", 172_800_000), ("1 hour", 3_600_000), ("90 minutes 1.5 seconds", 5_401_500), ("1 month 1 day", 32 * 86_400_000)])
def test_f23_delays_count_as_in_watermarks(spark, delay, ms):
    assert jobs._millis(spark, delay) == ms
