"""Review queues and run diagnostics."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType
from pyspark.sql.window import Window

from kermesse.functions import labels
from kermesse.functions.labels import classify_category
from kermesse.functions.rules import Rule
from kermesse.functions.text import classify_error, squeeze, url_host
from kermesse.operators.filters import is_current, is_real_place
from kermesse.operators.skew import best_row, top_k
from kermesse.schemas import RUN_LOG, conform
from kermesse.vocab.places import EXACT_PRECISIONS

STATUS_ORDER = {"error": 0, "no corrio": 1, "trajo cero": 2, "sin nada futuro": 3, "extrajo": 4, "apagada": 5}


def place_queue(published: DataFrame, real_only: bool = False) -> DataFrame:
    """Inexact places by the number of rows one correction would fix."""
    rows = published.filter(F.col("precision").isin("comuna", "sin_ubicar"))
    if real_only:
        rows = rows.filter((F.trim(F.coalesce("lugar", F.lit(""))) != "") & is_real_place(F.col("lugar")))
    addr = F.when(F.coalesce("direccion", F.lit("")) != "", F.struct("seq", "direccion"))
    return rows.groupBy(F.coalesce("lugar", F.lit("")).alias("lugar"),
                        F.coalesce("comuna", F.lit("")).alias("comuna")).agg(
        F.count(F.lit(1)).alias("eventos"),
        F.coalesce(F.min(addr)["direccion"], F.lit("")).alias("direccion"))


def merchant_queues(offers: DataFrame) -> DataFrame:
    """Merchants without an exact pin (``sin_pin``) and without a cuisine (``sin_cocina``)."""
    no_pin = offers.filter(F.coalesce("precision", F.lit("")).isin("comuna", "sin_ubicar", "")).groupBy("comercio").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("banco")).alias("bancos"))
    no_cuisine = offers.filter(F.coalesce("cocina", F.lit("")) == "").groupBy("comercio").agg(
        F.count(F.lit(1)).alias("n")).withColumn("bancos", F.lit(None).cast("array<string>"))
    return (no_pin.withColumn("cola", F.lit("sin_pin"))
            .unionByName(no_cuisine.withColumn("cola", F.lit("sin_cocina"))))


def impact_order(queue: DataFrame, count: str, *ties: str) -> DataFrame:
    return queue.orderBy(F.desc(count), *ties)


def uncategorised_queue(published: DataFrame) -> DataFrame:
    return published.filter(F.col("categoria") == "otros").orderBy(F.col("inicio").asc_nulls_last(), "seq")


def undated_queue(store: DataFrame) -> DataFrame:
    return (store.filter(F.col("estado") == "revisar_fecha")
            .orderBy(F.col("fecha_extraccion").desc(), "hash_dedup")
            .select("hash_dedup", "titulo", "fuente_nombre", "fuente_url", "fecha_extraccion"))


def precision_breakdown(published: DataFrame) -> DataFrame:
    """Rows and integer percentage per precision label."""
    counts = published.groupBy("precision").agg(F.count(F.lit(1)).alias("n"))
    # One row per label: the window spans at most the label set.
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", F.floor(F.col("n") * 100 / total).cast("int"))


def with_origin(store: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """Adds ``etiqueta``, ``origen`` (the layer that gave it) and ``regla``."""
    got = classify_category(F.col("titulo"), F.col("categoria"), F.col("descripcion_corta"),
                            F.col("lugar_nombre"), F.col("fuente_nombre"), rules)
    return store.withColumn("_c", got).withColumns({
        "etiqueta": F.col("_c.label"), "origen": F.col("_c.reason"), "regla": F.col("_c.rule")}).drop("_c")


def origin_breakdown(store: DataFrame) -> DataFrame:
    """Labels read from text, guessed from the venue, or defaulted."""
    kind = (F.when(F.col("origen").isin("titulo", "descripcion"), "texto")
            .when(F.col("origen") == "prior", "prior").otherwise("defecto"))
    return with_origin(store).groupBy(kind.alias("origen")).agg(F.count(F.lit(1)).alias("n"))


def rule_audit(store: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """How many rows each rule labelled, by axis: the rule, its label and the layer it read.

    Rows alike in all that the rules read are labelled once and counted as many; every axis is read once for them. They
    shrink to one per rule in each task before the shuffle.
    """
    c = F.col
    args = (c("lugar_nombre"), c("fuente_nombre"))
    read = ["titulo", "categoria", "descripcion_corta", "lugar_nombre", "fuente_nombre"]
    read += [x for x in ("precio_clp",) if x in store.columns]
    rows = with_origin(store.groupBy(*read).agg(F.count(F.lit(1)).alias("_n")), rules)
    # Each axis is one value with a name, taken apart after the explode: taken apart before, it is worked out for each part.
    axes = rows.select("_n", F.explode(F.array(
        F.struct(F.lit("categoria").alias("eje"), F.struct(c("etiqueta").alias("label"), c("origen").alias("reason"), c("regla").alias("rule")).alias("got")),
        *(F.struct(F.lit(axis).alias("eje"), got.alias("got")) for axis, got in (
            ("subcategoria", labels.classify_subcategory(c("etiqueta"), c("titulo"), c("categoria"), c("descripcion_corta"), *args, rules)),
            ("escala", labels.classify_scale(c("titulo"), *args, c("precio_clp") if "precio_clp" in store.columns else F.lit(None).cast("int"),
                                             c("descripcion_corta"), rules)),
            ("publico", labels.classify_audience(c("titulo"), c("descripcion_corta"), c("etiqueta"), *args, None, rules)))))).alias("r"))
    told = axes.select("_n", "r.eje", c("r.got.rule").alias("regla"), c("r.got.label").alias("etiqueta"),
                       F.when(c("r.eje") == "categoria", c("r.got.reason")).otherwise("").alias("capa"))
    return told.groupBy("eje", "regla", "etiqueta", "capa").agg(F.sum("_n").alias("n"))


def first_seen_places(store: DataFrame, as_of: Column) -> DataFrame:
    """Places whose first row entered the store today."""
    named = store.filter(F.trim(F.coalesce("lugar_nombre", F.lit(""))) != "")
    return (named.groupBy("lugar_nombre").agg(
        F.min("comuna").alias("comuna"), F.count(F.lit(1)).alias("n"),
        F.min(F.col("fecha_extraccion").cast("date")).alias("_first"))
        .filter(F.col("_first") == as_of.cast("date")).drop("_first"))


def latest_run_per_source(runs: DataFrame, as_of: Column) -> DataFrame:
    """The last run of the day for each source; of a log partitioned by day only that day is read."""
    day = F.col("dia") if "dia" in runs.columns else F.col("momento").cast("date")
    return best_row(runs.filter(day == as_of.cast("date")), ["fuente"], [F.col("momento")], largest=True)


def degraded_sources(runs: DataFrame, active: DataFrame | None = None, last: int = 3) -> DataFrame:
    """Active sources whose last runs all failed or brought nothing."""
    rows = runs if active is None else runs.join(active.select("fuente").distinct(), "fuente", "left_semi")
    recent = top_k(rows, ["fuente"], [F.col("momento").desc()], last, "_n")
    failed = F.coalesce("error", F.lit("")) != ""
    bad = failed | (F.coalesce("encontrados", F.lit(0)) == 0)
    return (recent.groupBy("fuente").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(bad).alias("bad"),
        F.coalesce(F.min(F.when(failed, F.struct("_n", "error")))["error"], F.lit("")).alias("ultimo_error"),
        F.date_format(F.min("momento"), "yyyy-MM-dd").alias("desde"))
        .filter((F.col("n") >= last) & F.col("bad")).select("fuente", "ultimo_error", "desde"))


def failure_runs(fetches: DataFrame) -> DataFrame:
    """host, peor (longest run of consecutive failures), racha (the run still open at the newest row).

    ``fetches(host, ts, seq, ok)`` in any order. Rows first shrink to one row per host and hour with the
    shape of its runs (leading, trailing, longest), so a busy host meets as hours only.
    """
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    w = Window.partitionBy("host", "_h").orderBy("ts", "seq")
    bits = fetches.withColumn("_h", hour)
    runs = (bits.withColumn("_g", F.sum(F.when(F.col("ok"), 1).otherwise(0)).over(w))
            .groupBy("host", "_h", "_g").agg(
                F.count_if(~F.col("ok")).alias("bad"), F.bool_or("ok").alias("has_ok")))
    per_hour = runs.groupBy("host", "_h").agg(
        F.max("bad").alias("longest"), F.max(F.struct("_g", "bad"))["bad"].alias("tail"),
        F.max(F.when(F.col("_g") == 0, F.col("bad"))).alias("head"),
        F.max("_g").alias("oks"), F.sum("bad").alias("bad"))
    hours = Window.partitionBy("host").orderBy("_h")
    # Hours without any success chain with their neighbours.
    marked = per_hour.withColumn("_blk", F.sum(F.when(F.col("oks") > 0, 1).otherwise(0)).over(hours))
    chains = marked.groupBy("host", "_blk").agg(
        F.sum(F.when(F.col("oks") > 0, F.col("tail")).otherwise(F.col("bad"))).alias("chain"),
        F.max("longest").alias("inner"))
    heads = marked.filter("oks > 0").select("host", (F.col("_blk") - 1).alias("_blk"),
                                            F.coalesce("head", F.lit(0)).alias("head"))
    joined = chains.join(heads, ["host", "_blk"], "left")
    longest = F.greatest(F.col("chain") + F.coalesce("head", F.lit(0)), F.col("inner"))
    first_head = heads.filter("_blk = 0").select("host", F.col("head").alias("longest"), F.lit(-1).cast("bigint").alias("_blk"),
                                                 F.lit(0).cast("bigint").alias("chain"))
    return (joined.select("host", longest.alias("longest"), "_blk", "chain").unionByName(first_head).groupBy("host").agg(
        F.max("longest").alias("peor"), F.max(F.struct("_blk", "chain"))["chain"].alias("racha")))


def failure_streaks(fetches: DataFrame, minimum: int = 3) -> DataFrame:
    """Hosts whose longest run of consecutive failures reaches ``minimum``."""
    return failure_runs(fetches).select("host", F.col("peor").alias("racha")).filter(F.col("racha") >= minimum)


def attach_domain_failures(sources: DataFrame, log: DataFrame, since: Column) -> DataFrame:
    """Failures of each source's host since the run began: count and earliest cause."""
    failed = log.filter(~F.col("ok") & (F.col("ts") >= since)).withColumn("host", url_host(F.col("url")))
    per_host = failed.filter("host != ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("caidas"),
        F.min(F.struct("ts", classify_error(squeeze(F.col("message"))).alias("m")))["m"].alias("causa"))
    return sources.withColumn("host", url_host(F.col("url_base"))).join(per_host, "host", "left").drop("host")


def stale_sources(latest: DataFrame, store: DataFrame, as_of: Column) -> DataFrame:
    """Sources that answered with rows and have nothing current."""
    alive = store.filter(is_current(F.col("inicio"), F.col("fin"), as_of)).select(
        F.col("fuente_nombre").alias("fuente")).distinct()
    good = latest.filter((F.coalesce("error", F.lit("")) == "") & (F.coalesce("encontrados", F.lit(0)) > 0))
    return good.join(alive, "fuente", "left_anti").select("fuente")


def source_status_catalogue(config: DataFrame, latest: DataFrame, published: DataFrame,
                            stale: DataFrame) -> DataFrame:
    """Every configured source with its status, whether it ran or not."""
    counts = published.groupBy(F.col("fuente").alias("nombre")).agg(F.count(F.lit(1)).alias("en_sitio"))
    out = (config.join(latest.withColumnRenamed("fuente", "nombre").withColumn("_ran", F.lit(True)), "nombre", "left")
           .join(counts, "nombre", "left")
           .join(stale.select(F.col("fuente").alias("nombre"), F.lit(True).alias("_stale")), "nombre", "left"))
    status = (F.when(~F.coalesce("activa", F.lit(True)), "apagada")
              .when(F.col("_ran").isNull(), "no corrio")
              .when(F.coalesce("error", F.lit("")) != "", "error")
              .when(F.coalesce("encontrados", F.lit(0)) == 0, "trajo cero")
              .when(F.col("tipo_adaptador") == "manual", "extrajo")
              .when(F.coalesce("_stale", F.lit(False)), "sin nada futuro").otherwise("extrajo"))
    return out.select("nombre", "tipo_adaptador", status.alias("estado"), "encontrados", "nuevos",
                      "actualizados", "descartados", F.coalesce("en_sitio", F.lit(0)).alias("en_sitio"))


def status_order(catalogue: DataFrame) -> DataFrame:
    rank = F.lit(9)
    for name, n in STATUS_ORDER.items():
        rank = F.when(F.col("estado") == name, n).otherwise(rank)
    return catalogue.orderBy(rank, F.lower("nombre"))


def review_queue(published: DataFrame) -> DataFrame:
    """One reason per doubtful row; ``origen`` comes from :func:`with_origin`."""
    reason = (F.when(F.col("precision") == "sin_ubicar", "1. sin pin")
              .when(F.col("categoria") == "otros", "2. sin categoria")
              .when(F.col("origen") == "prior", "3. categoria adivinada")
              .when(F.col("precision") == "comuna", "4. pin aproximado"))
    return published.withColumn("motivo", reason).filter("motivo is not null")


def source_run_counts(labelled: DataFrame) -> DataFrame:
    """found / new / updated / discarded per source from rows labelled with their outcome."""
    return labelled.groupBy("fuente_nombre").agg(
        F.count(F.lit(1)).alias("encontrados"), F.count_if(F.col("resultado") == "nuevo").alias("nuevos"),
        F.count_if(F.col("resultado") == "actualizado").alias("actualizados"),
        F.count_if(F.col("motivo").isNotNull()).alias("descartados"))


def run_log(counts: DataFrame, now: Column, errors: DataFrame | None = None) -> DataFrame:
    """The log rows of one run: a row per source with counts, error text and duration.

    ``errors(fuente, error, duracion_seg)`` adds what the extraction reported, sources that brought nothing included.
    """
    rows = counts.withColumnRenamed("fuente_nombre", "fuente")
    if errors is not None:
        rows = rows.join(errors.select("fuente", "error", "duracion_seg"), "fuente", "full_outer")
    stamped = rows.withColumn("momento", now.cast("timestamp_ntz"))
    zero = {c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in ("encontrados", "nuevos", "actualizados", "descartados")}
    return conform(stamped.withColumns(zero), RUN_LOG).withColumn("error", F.coalesce("error", F.lit("")))


def append_run_log(rows: DataFrame, path: str) -> DataFrame:
    """Append a run to the log at ``path``, in the partition of its day, and return the whole log."""
    rows.withColumn("dia", F.col("momento").cast("date")).write.mode("append").partitionBy("dia").parquet(path)
    return read_run_log(rows.sparkSession, path, rows.schema)


def read_run_log(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The log; filters on ``dia`` read the folders of those days only."""
    known = schema or StructType.fromDDL(RUN_LOG)
    return spark.read.schema(StructType([*known.fields, StructField("dia", DateType())])).parquet(path)


def expire_run_log(spark: SparkSession, path: str, first_kept: str) -> list[str]:
    """Drop the days before ``first_kept`` (``YYYY-MM-DD``) as whole partitions; returns what was dropped."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = [f.getPath() for f in fs.listStatus(root) if f.isDirectory() and f.getPath().getName().startswith("dia=")]
    gone = [d for d in days if re.fullmatch(r"dia=\d{4}-\d\d-\d\d", d.getName()) and d.getName()[4:] < first_kept]
    for d in gone:
        fs.delete(d, True)
    return sorted(d.getName()[4:] for d in gone)


def run_diagnostics(latest: DataFrame, stale: DataFrame, published: DataFrame,
                    before_ids: DataFrame) -> DataFrame:
    """One row of run figures; every part is a one-row aggregate put side by side."""
    failed = F.coalesce("error", F.lit("")) != ""
    runs = latest.agg(
        F.round(F.coalesce(F.sum("duracion_seg"), F.lit(0.0)) / 60, 1).alias("duracion_min"),
        F.count(F.lit(1)).alias("fuentes_total"), F.count_if(failed).alias("fuentes_error"),
        F.count_if(~failed & (F.coalesce("encontrados", F.lit(0)) == 0)).alias("fuentes_en_cero"),
        F.coalesce(F.sum("encontrados"), F.lit(0)).alias("encontrados"))
    pins = published.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("precision").isin(*EXACT_PRECISIONS)).alias("exactos"),
        F.count_if(F.col("precision") == "comuna").alias("aprox"),
        F.count_if(F.col("precision") == "sin_ubicar").alias("sin_pin"),
        F.count_if(F.col("categoria") == "otros").alias("otros"))
    now, old = published.select("id").distinct(), before_ids.select("id").distinct()
    adds = now.join(old, "id", "left_anti").agg(F.count(F.lit(1)).alias("altas"))
    removes = old.join(now, "id", "left_anti").agg(F.count(F.lit(1)).alias("bajas"))
    empties = stale.agg(F.count(F.lit(1)).alias("fuentes_vacias"))
    one = lambda d: d.withColumn("_k", F.lit(1))
    out = one(runs)
    for part in (empties, pins, adds, removes):
        out = out.join(one(part), "_k")
    return out.drop("_k")
