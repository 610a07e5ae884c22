"""Streaming twins agree with their batch operators."""

import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kermesse.bindings import inputs, streams
from kermesse.bindings.tables import stamp
from kermesse.operators import collapse, review
from kermesse.schemas import CANDIDATE, conform
from kermesse.streaming import jobs


def test_stream_seasons_are_batch_seasons(spark, sf):
    rows = lambda df: {tuple(r) for r in df.select("seq", stamp("inicio"), stamp("fin")).collect()}
    assert {(r.seq, r.inicio, r.fin) for r in streams.s02(spark, sf).collect()} == rows(collapse.collapse_multiday(inputs.candidates(spark, sf)))


def test_replayed_rows_change_nothing(spark, sf, tmp_path):
    rows = streams._candidates(spark, sf)
    for ck in ("a", "b"):
        jobs.stream_upsert(rows, str(tmp_path / "store"), str(tmp_path / ck), inputs.now()).awaitTermination()
    once = streams.s01(spark, sf)
    again = jobs.read_snapshot(spark, str(tmp_path / "store"))
    assert again.count() == once.count()


def test_new_checkpoint_keeps_the_store(spark, sf, tmp_path):
    rows = streams._candidates(spark, sf)
    store = str(tmp_path / "store")
    for ck, part in (("a", "seq % 2 = 0"), ("b", "seq % 2 = 1"), ("c", "seq % 2 = 1 and seq % 3 = 0")):
        jobs.stream_upsert(rows.filter(part), store, str(tmp_path / ck), inputs.now()).awaitTermination()
    assert jobs.read_snapshot(spark, store).select("hash_dedup").distinct().count() == streams.s01(spark, sf).count()


FETCHES = "event_type AS host", "cast(ts AS timestamp_ntz) AS ts", "event_id AS seq", "user_id % 3 = 0 AS ok"


def counted(rows, limit=3):
    want = {}
    for r in sorted(rows, key=lambda r: (r.ts, r.seq)):
        run, worst = want.get(r.host, (0, 0))
        run = 0 if r.ok else run + 1
        want[r.host] = (run, max(worst, run))
    return {(h, run, worst, run >= limit) for h, (run, worst) in want.items()}


@pytest.mark.parametrize("order, lateness", [("xxhash64(seq)", "60 days"), ("ts", "1 hour")])
def test_circuit_counts_over_micro_batches_and_restarts(spark, sf, tmp_path, order, lateness):
    """Rows in any order within the lateness, or in time order with the watermark close behind; two runs of one checkpoint."""
    fetches = spark.read.parquet(f"{sf}/events.parquet").selectExpr(*FETCHES)
    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    half = fetches.count() // 2
    numbered = fetches.withColumn("_n", F.row_number().over(Window.orderBy(F.expr(order), "seq")))
    for part in (F.col("_n") <= half, F.col("_n") > half):
        for third in range(3):  # one file after the other
            numbered.filter(part & (F.floor(F.col("_n") * 6 / (2 * half + 2)) % 3 == third)).drop("_n").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(fetches.schema).option("maxFilesPerTrigger", 1).parquet(src)
        jobs.stream_circuit(stream, str(tmp_path / "out"), ck, lateness).awaitTermination()
    assert {tuple(r) for r in jobs.read_circuit(spark, ck).collect()} == counted(fetches.collect())
    pending = spark.read.format("statestore").option("path", ck).option("stateVarName", "pendientes").load().count()
    assert pending == fetches.count() if lateness == "60 days" else pending < fetches.count() / 5


SEEN = lambda df: sorted(tuple(map(str, r)) for r in df.select("seq", stamp("inicio"), stamp("fin"), "precio_texto", "precio_clp").collect())


def test_seasons_close_once_and_stay_whole(spark, sf, tmp_path):
    """Time order, the watermark close behind, an undated row, a restart: closed, open and undated rows are the batch result."""
    rows = inputs.candidates(spark, sf).withColumn("inicio", F.when(F.col("seq") % 100 != 7, F.col("inicio")))
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    numbered = rows.withColumn("_n", F.row_number().over(Window.orderBy("inicio", "seq")))
    half = rows.count() // 2
    for part in (F.col("_n") <= half, F.col("_n") > half):
        for third in range(3):  # one file after the other
            numbered.filter(part & (F.floor(F.col("_n") * 6 / (2 * half + 2)) % 3 == third)).drop("_n").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
        jobs.stream_collapse(stream, out, ck, "1 hour").awaitTermination()
    closed = jobs.read_results(spark, out, "cerrada")
    assert closed.count() == closed.select("first.s").distinct().count() > 100
    assert jobs.open_seasons(spark, ck).count() > 0 and jobs.read_results(spark, out, "tarde").count() == 0
    assert jobs.read_results(spark, out, "sin_fecha").count() == rows.filter("inicio is null").count() > 0
    assert SEEN(jobs.read_seasons(spark, out, ck)) == SEEN(collapse.collapse_multiday(rows))


def test_seasons_merge_in_any_order_and_set_late_rows_aside(spark, tmp_path):
    """Days that arrive backwards bridge open seasons; after a season has closed, a row that could join it is set aside."""
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = conform(spark.range(0), CANDIDATE).schema

    def put(days):
        made = [(s, datetime.datetime(2024, 1, 1, 20) + datetime.timedelta(days=d)) for s, d in days]
        rows = spark.createDataFrame(made, "seq long, inicio timestamp_ntz").withColumns({"titulo": F.lit("Obra"), "lugar_nombre": F.lit("Sala")})
        conform(rows, CANDIDATE).coalesce(1).write.mode("append").parquet(src)
        jobs.stream_collapse(spark.readStream.schema(schema).parquet(src), out, ck, "10 days", gap=4).awaitTermination()
        return [(r.seq, r.fin.day) for r in jobs.read_seasons(spark, out, ck).where("fin is not null").orderBy("inicio").collect()]

    assert put([(1, 9), (2, 1), (3, 2)]) == [(2, 3)]  # the 10th, the 2nd and the 3rd: the first stands alone
    assert put([(4, 5)]) == [(2, 10)]  # the 6th bridges both
    assert put([(5, 40)]) == [(2, 10)]  # the watermark passes: the season closes
    assert jobs.read_results(spark, out, "cerrada").count() == 1
    assert put([(6, 10)]) == [(2, 10)]
    late = jobs.read_results(spark, out, "tarde").select("first.row.seq").collect()
    assert [r.seq for r in late] == [6] and jobs.open_seasons(spark, ck).count() == 1


def test_failure_runs_small_cases(spark):
    t = datetime.datetime(2024, 1, 1)
    for pattern in ("f", "o", "ff", "fo", "of", "offo", "ffoff", "fffffo", "offffff"):
        rows = [("h", t + datetime.timedelta(minutes=40 * i), i, c == "o") for i, c in enumerate(pattern)]
        r = review.failure_runs(spark.createDataFrame(rows, "host string, ts timestamp_ntz, seq long, ok boolean")).first()
        runs = pattern.split("o")
        assert (r.peor, r.racha) == (max(map(len, runs)), len(runs[-1])), pattern
