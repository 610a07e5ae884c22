"""Structured Streaming twins of the batch operators."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.functions.text import url_host
from kermesse.operators.collapse import partial_seasons, season_parts, season_rows
from kermesse.operators.store import upsert_events
from kermesse.schemas import CANDIDATE, STORE, names
from kermesse.session import ship_package
from kermesse.streaming.state import CIRCUIT, SEASON, SEASON_NAMES, Circuit, Seasons
from kermesse.vocab.calendar import MAX_SEASON_GAP_DAYS

def _if_written(read) -> DataFrame | None:
    """What ``read`` returns, or None where nothing was written yet; any other error is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


POINTER = "carpeta string, origen string, lote bigint"


def _newest(spark: SparkSession, path: str):
    found = _if_written(lambda: spark.read.schema(POINTER).parquet(f"{path}/_actual"))
    return None if found is None else found.first()


def stream_upsert(candidates: DataFrame, path: str, checkpoint: str, now: Column):
    """Upsert each micro-batch into the store at ``path``.

    A micro-batch writes its folder, then points to it. A batch that the pointer already names is a replay and is left
    out; any other replay writes its own folder again.
    """
    spark = candidates.sparkSession

    def write(batch: DataFrame, lot: int) -> None:
        last = _newest(spark, path)
        if last is not None and (last.origen, last.lote) == (checkpoint, lot):
            return
        folder = f"snapshot={uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex}-{lot}"
        upsert_events(read_snapshot(spark, path), batch, now).drop("resultado").write.mode("overwrite").parquet(f"{path}/{folder}")
        spark.createDataFrame([(folder, checkpoint, lot)], POINTER).write.mode("overwrite").parquet(f"{path}/_actual")

    return (candidates.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The store as of the newest micro-batch, or an empty one where nothing was written yet."""
    last = _newest(spark, path)
    if last is None:
        return spark.createDataFrame([], STORE)
    return spark.read.schema(STORE).parquet(f"{path}/{last.carpeta}").select(*names(STORE))


def _keyed_state(spark: SparkSession) -> None:
    """Processors keep several states a key, which needs the store that holds more than one."""
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


# -- seasons ----------------------------------------------------------------------------------

def stream_collapse(candidates: DataFrame, path: str, checkpoint: str, lateness: str = "30 days", gap: int = MAX_SEASON_GAP_DAYS):
    """Keep the open seasons of every series as state and write each season once, when it closes.

    A season closes when the watermark (the latest start seen, less ``lateness``) has passed the last day that could
    still join it. Rows come in any order; one that starts before the watermark is late: it may belong to a season that
    was written, so it goes to the table ``tarde`` and changes nothing. Undated rows are written as they come.

    Two streams follow each other. The first folds each micro-batch's rows to partial seasons, a few a series, by columns
    (``partials``); the second merges those into the state, so that its Python processor sees no single rows.

    Results are the folders ``tipo=cerrada``, ``tipo=tarde`` and ``tipo=sin_fecha`` of each micro-batch; a replayed one
    writes its own folder again. ``read_seasons`` adds the open seasons, read from the state.
    """
    spark = candidates.sparkSession
    _keyed_state(spark)
    folded = f"{checkpoint}/parciales"
    stream_partials(candidates, path, folded, lateness, gap).awaitTermination()
    # Lots are read whole: the watermark holds for all series of a lot. None may be passed over as old after a failed run.
    partials = spark.readStream.schema(f"serie string, {SEASON}").option("maxFileAge", "36500d").parquet(f"{folded}/filas")
    # The watermark's own column stays outside: with it Spark would drop late rows without a word.
    rows = partials.withColumn("_hora", F.col("last.t").cast("timestamp")).withWatermark("_hora", lateness)
    told = rows.select("serie", *SEASON_NAMES).groupBy("serie").transformWithState(Seasons(gap), SEASON, "Append", "EventTime")

    def write(batch: DataFrame, lot: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{_origin(checkpoint)}/lote={lot:010d}/tipo=cerrada")

    return told.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_partials(candidates: DataFrame, path: str, folder: str, lateness: str, gap: int):
    """Fold each micro-batch's rows to partial seasons in ``folder``; late and undated rows go to ``path`` as they are.

    The newest start up to each lot is kept in ``folder``, so what is late does not hang on how the next stream batches.
    """
    spark, delay = candidates.sparkSession, _millis(candidates.sparkSession, lateness)
    rows = candidates.select(*names(CANDIDATE))
    undated, starts = F.col("inicio").isNull(), F.unix_millis(F.col("inicio").cast("timestamp"))

    def newest(lot: int) -> int | None:
        return None if lot < 0 else spark.read.schema("ms bigint").parquet(f"{folder}/hasta/lote={lot:010d}").first().ms

    def write(batch: DataFrame, lot: int) -> None:
        before, own = newest(lot - 1), f"{folder}/filas/lote={lot:010d}"
        late = F.lit(False) if before is None else starts <= before - delay
        partial_seasons(batch.where(~undated & ~late), gap).withColumnRenamed("_serie", "serie").write.mode("overwrite").parquet(own)
        parts = {c: F.when(~undated, part) for c, part in season_parts(names(CANDIDATE)).items()}
        parts |= {c: season_parts(names(CANDIDATE))[c] for c in ("n", "first")}
        aside = batch.where(undated | late).select(*[parts[c].alias(c) for c in SEASON_NAMES], F.when(undated, "sin_fecha").otherwise("tarde").alias("tipo"))
        aside.write.mode("overwrite").partitionBy("tipo").parquet(f"{path}/{_origin(folder)}/lote={lot:010d}")
        last = spark.read.schema(SEASON).parquet(own).agg(F.max(F.unix_millis(F.col("last.t").cast("timestamp"))).alias("ms"))
        last.select(F.greatest("ms", F.lit(before).cast("bigint")).alias("ms")).write.mode("overwrite").parquet(f"{folder}/hasta/lote={lot:010d}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()


def _millis(spark: SparkSession, delay: str) -> int:
    """A delay as ``withWatermark`` counts it, months as 31 days."""
    part = {p: f"extract({p} FROM CAST('{delay}' AS INTERVAL))" for p in ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND")}
    days = f"(({part['YEAR']} * 12 + {part['MONTH']}) * 31 + {part['DAY']})"
    return spark.range(1).selectExpr(f"bigint((({days} * 24 + {part['HOUR']}) * 60 + {part['MINUTE']}) * 60000L + {part['SECOND']} * 1000) AS ms").first().ms


def _origin(checkpoint: str) -> str:
    return f"origen=q{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex}"


def read_results(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The seasons of one ``tipo`` that were written: ``cerrada``, ``tarde`` or ``sin_fecha``."""
    found = _if_written(lambda: spark.read.schema(f"{SEASON}, tipo string").option("basePath", path).parquet(path))
    return spark.createDataFrame([], SEASON) if found is None else found.where(F.col("tipo") == kind).select(*SEASON_NAMES)


def open_seasons(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Seasons that may still grow, from the state of the newest micro-batch."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "temporadas").load()
    return state.select("list_element.*").select(*SEASON_NAMES)


def read_seasons(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Candidate rows with each season as one: closed, open and undated ones."""
    every = read_results(spark, path, "cerrada").unionByName(open_seasons(spark, checkpoint))
    undated = read_results(spark, path, "sin_fecha").select("first.row.*")
    return season_rows(every, names(CANDIDATE)).unionByName(undated.select(*names(CANDIDATE)))


# -- first sightings --------------------------------------------------------------------------

def stream_dedup(rows: DataFrame, time: str = "ts", lateness: str = "1 day", keys: tuple[str, ...] = ("endpoint", "id_externo")) -> DataFrame:
    """First row per key within the watermark."""
    return rows.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))



# -- failure circuit --------------------------------------------------------------------------

def stream_circuit(fetches: DataFrame, path: str, checkpoint: str, lateness: str = "1 day", limit: int = 3):
    """Keep each host's failure counter as state, from fetches (``host`` or ``url``, ``ts``, ``seq``, ``ok``).

    Counts follow the order of ``ts`` and ``seq``, whatever order rows come in, as long as they come within ``lateness`` of
    the newest one; later ones are refused. The state of a host is its settled counter and the rows that the watermark
    has not passed; a timer settles them when it has. Each micro-batch writes the hosts whose counter it changed; the
    whole circuit is read from the state.
    """
    _keyed_state(fetches.sparkSession)
    keyed = fetches if "host" in fetches.columns else fetches.withColumn("host", url_host(F.col("url")))
    time = F.col("ts").cast("timestamp")
    rows = keyed.select("host", time.alias("ts"), F.unix_micros(time).alias("us"), F.col("seq").cast("bigint").alias("seq"), "ok").withWatermark("ts", lateness)
    told = rows.groupBy("host").transformWithState(Circuit(limit), CIRCUIT, "Update", "EventTime")

    def write(batch: DataFrame, lot: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{_origin(checkpoint)}/lote={lot:010d}")

    return told.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_circuit(spark: SparkSession, checkpoint: str) -> DataFrame:
    """host, racha, peor, abierto of every host, from the state of the newest micro-batch."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "ahora").load()
    return state.select("key.host", "value.racha", "value.peor", "value.abierto")
