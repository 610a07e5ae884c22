"""Streaming twins driven to completion over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kermesse.bindings import inputs as i
from kermesse.bindings.registry import ORACLES, register
from kermesse.bindings.tables import FMT, KEYED, stamp
from kermesse.schemas import CANDIDATE, conform
from kermesse.session import ensure_checkpoint_dir
from kermesse.streaming import jobs


def _work(spark) -> str:
    """A fresh folder under the cluster's shared checkpoint folder (a temporary one in tests)."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/stream-{uuid.uuid4().hex}"


def _events(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _candidates(spark, sf):
    cols = [f"{e.replace('{k}', i.SPARK_K)} AS {n}" for n, e in i.CAND_COLS.items()]
    return conform(_events(spark, sf).selectExpr(*cols), CANDIDATE)


def _drain(df, spark, mode="append"):
    """Run a stream over what is there now and return what it wrote."""
    work = _work(spark)
    out = f"{work}/out"

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{work}/ck").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@register("s01_stream_upsert", f"WITH {KEYED} SELECT hash_dedup, titulo, strftime(inicio, {FMT}) AS inicio, lat, precio_clp FROM stored")
def s01(spark, sf):
    work = _work(spark)
    jobs.stream_upsert(_candidates(spark, sf), f"{work}/store", f"{work}/ck", i.now()).awaitTermination()
    return jobs.read_snapshot(spark, f"{work}/store").select("hash_dedup", "titulo", stamp("inicio").alias("inicio"), "lat", "precio_clp")


@register("s02_stream_collapse", ORACLES["d01_collapse_multiday"])
def s02(spark, sf):
    work = _work(spark)
    jobs.stream_collapse(_candidates(spark, sf), f"{work}/out", f"{work}/ck", "2 days").awaitTermination()
    return jobs.read_seasons(spark, f"{work}/out", f"{work}/ck").select(
        "seq", stamp("inicio").alias("inicio"), stamp("fin").alias("fin"), "precio_texto", "imagen_url", "precio_clp", "es_gratis")


@register("s03_stream_dedup", "SELECT DISTINCT event_type AS endpoint, user_id AS id_externo FROM events")
def s03(spark, sf):
    rows = _events(spark, sf).selectExpr("cast(ts AS timestamp) AS ts", "event_type AS endpoint", "user_id AS id_externo")
    return _drain(jobs.stream_dedup(rows, lateness="60 days"), spark).select("endpoint", "id_externo")


@register("s04_stream_circuit", """WITH f AS (SELECT event_type AS host, ts, event_id, user_id % 3 = 0 AS ok FROM events),
g AS (SELECT *, sum(ok::int) OVER (PARTITION BY host ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM f), r AS (SELECT host, grp, count(*) FILTER (NOT ok) AS n FROM g GROUP BY host, grp)
SELECT host, CAST(max(n) AS int) AS peor, CAST(last(n ORDER BY grp) AS int) AS racha FROM r GROUP BY host""")
def s04(spark, sf):
    rows = _events(spark, sf).selectExpr("event_type AS host", "ts", "event_id AS seq", "user_id % 3 = 0 AS ok")
    work = _work(spark)
    jobs.stream_circuit(rows, f"{work}/out", f"{work}/ck").awaitTermination()
    return jobs.read_circuit(spark, f"{work}/ck").select("host", F.col("peor").cast("int").alias("peor"), F.col("racha").cast("int").alias("racha"))
