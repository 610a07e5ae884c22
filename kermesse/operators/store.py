"""The event store: snapshot upserts, life cycle and retention."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.functions.text import fold_text
from kermesse.operators.collapse import event_hash
from kermesse.operators.filters import is_current
from kermesse.schemas import STORE, conform, names

REFRESHED = ("titulo", "categoria", "descripcion_corta", "inicio", "fin", "lugar_nombre",
             "lugar_direccion", "comuna", "precio_clp", "es_gratis", "precio_texto",
             "fuente_url", "link_entradas", "imagen_url")
KEPT_IF_ABSENT = ("lat", "lon")


def upsert_events(store: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """New snapshot plus ``resultado`` (nuevo, actualizado or NULL for untouched rows).

    Within one batch the last row of a key wins, except that a missing coordinate never
    erases one. The curator's state and the first-seen facts are never touched.
    """
    keyed = batch.withColumn("hash_dedup", event_hash())
    facts = [c for c in names(STORE) if c not in (
        "hash_dedup", "fecha_extraccion", "fecha_ultima_verificacion", "visto_por_ultima_vez", "estado", "estado_previo")]
    last_of = {c: F.max(F.struct("seq", c))[c] for c in REFRESHED}
    first_of = {c: F.min(F.struct("seq", c))[c] for c in facts if c not in REFRESHED}
    point = {c: F.max(F.when(F.col(c).isNotNull(), F.struct("seq", c)))[c] for c in KEPT_IF_ABSENT}
    incoming = keyed.groupBy("hash_dedup").agg(*[
        (point.get(c) if c in point else last_of.get(c, first_of.get(c))).alias(f"n_{c}") for c in facts],
        F.min(F.struct("seq", F.col("inicio").isNull().alias("x")))["x"].alias("_undated")).withColumn("_new", F.lit(True))
    old = conform(store, STORE).select("hash_dedup", *[F.col(c).alias(f"o_{c}") for c in names(STORE)[1:]]
                       ).withColumn("_old", F.lit(True))
    both = old.join(incoming, "hash_dedup", "full_outer")
    is_old = F.coalesce(F.col("_old"), F.lit(False))
    touched = F.coalesce(F.col("_new"), F.lit(False))

    def value(c: str) -> Column:
        if c in REFRESHED:
            return F.when(touched, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))
        if c in KEPT_IF_ABSENT:
            return F.coalesce(F.col(f"n_{c}"), F.col(f"o_{c}"))
        return F.when(is_old, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}"))

    stamp = now.cast("timestamp_ntz")
    special = {
        "hash_dedup": F.col("hash_dedup"),
        "fecha_extraccion": F.when(is_old, F.col("o_fecha_extraccion")).otherwise(stamp),
        "fecha_ultima_verificacion": F.when(touched, stamp).otherwise(F.col("o_fecha_ultima_verificacion")),
        "visto_por_ultima_vez": F.when(touched, stamp).otherwise(F.col("o_visto_por_ultima_vez")),
        "estado": F.when(is_old, F.col("o_estado")).when(F.col("_undated"), "revisar_fecha")
        .otherwise("borrador"),
        "estado_previo": F.col("o_estado_previo"),
    }
    return both.select(*[special.get(c, value(c) if c not in special else None).alias(c)
                         for c in names(STORE)],
                       F.when(touched & is_old, "actualizado").when(touched, "nuevo").alias("resultado"))


def expire_past(store: DataFrame, as_of: Column, remember: bool = True) -> DataFrame:
    """Ended rows become ``caducado``; the state they had is kept in ``estado_previo``."""
    over = F.coalesce(F.coalesce("fin", "inicio").cast("date") < as_of.cast("date"), F.lit(False))
    due = over & (F.col("estado") != "caducado")
    before = F.col("estado_previo") if "estado_previo" in store.columns else F.lit(None).cast("string")
    out = store.withColumn("estado_previo", F.when(due, F.col("estado")).otherwise(before)) if remember else store
    return out.withColumn("estado", F.when(due, "caducado").otherwise(F.col("estado")))


def revive_current(store: DataFrame, as_of: Column) -> DataFrame:
    """Expired rows that still run get back the state they had, else ``borrador``; what was remembered is cleared."""
    due = (F.col("estado") == "caducado") & is_current(F.col("inicio"), F.col("fin"), as_of)
    before = F.coalesce(F.col("estado_previo"), F.lit("borrador")) if "estado_previo" in store.columns \
        else F.lit("borrador")
    out = store.withColumn("_due", F.coalesce(due, F.lit(False))).withColumn("estado", F.when(F.col("_due"), before).otherwise(F.col("estado")))
    if "estado_previo" in store.columns:
        out = out.withColumn("estado_previo", F.when(~F.col("_due"), F.col("estado_previo")))
    return out.drop("_due")


def pending_review(store: DataFrame, as_of: Column) -> DataFrame:
    return store.filter((F.col("estado") == "borrador")
                        & is_current(F.col("inicio"), F.col("fin"), as_of)).orderBy("inicio", "hash_dedup")


def new_today(store: DataFrame, as_of: Column) -> DataFrame:
    return store.filter((F.col("fecha_extraccion").cast("date") == as_of.cast("date"))
                        & (F.col("estado") == "borrador")).orderBy("comuna", "inicio", "hash_dedup")


def store_summary(store: DataFrame, as_of: Column) -> DataFrame:
    return store.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("estado") == "borrador").alias("borradores"),
        F.count_if(F.col("estado") == "publicado").alias("publicados"),
        F.count_if(F.col("es_gratis") & (F.col("estado") != "caducado")).alias("gratis"),
        F.count_if(is_current(F.col("inicio"), F.col("fin"), as_of)).alias("vigentes"))


# Wall-clock stamps keep their microseconds in the text form.
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def snapshot_lines(store: DataFrame) -> DataFrame:
    """``(hash_dedup, line)``: one JSON text per row with sorted keys and explicit NULLs."""
    cols = sorted(c for c in names(STORE) if c in store.columns)
    return store.select("hash_dedup", F.to_json(F.struct(*cols), JSON_OPTIONS).alias("line"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Store rows from snapshot lines; unknown columns are ignored, absent ones are NULL."""
    row = F.from_json("line", STORE, {"timestampNTZFormat": JSON_OPTIONS["timestampNTZFormat"]})
    return conform(lines.select(row.alias("r")).select("r.*"), STORE)


def table_fingerprint(df: DataFrame, *cols: str) -> DataFrame:
    """One-row content fingerprint: row count and order-free 64-bit sums.

    Two independent hashes are folded with sums, so the driver never sees the rows.
    """
    cols = cols or tuple(df.columns)
    part = lambda seed: F.sum(F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 40)))
    return df.agg(F.count(F.lit(1)).alias("filas"),
                  F.coalesce(part(1), F.lit(0)).alias("h1"), F.coalesce(part(2), F.lit(0)).alias("h2"))


def write_snapshot(store: DataFrame, path: str) -> None:
    """Sorted JSON lines next to a one-row metadata table with the fingerprint."""
    lines = snapshot_lines(store)
    lines.orderBy("hash_dedup").select("line").write.mode("overwrite").text(f"{path}/rows")
    table_fingerprint(lines).write.mode("overwrite").parquet(f"{path}/meta")


def restore_snapshot(spark, path: str, current: DataFrame | None) -> DataFrame:
    """The stored rows when the table is empty or differs; an empty file never wipes it."""
    raw = spark.read.text(f"{path}/rows")
    loaded = parse_lines(raw.select(F.col("value").alias("line")))
    if current is None or current.isEmpty():
        return loaded
    if raw.isEmpty():
        return current
    known = spark.read.parquet(f"{path}/meta").first()
    here = table_fingerprint(snapshot_lines(current)).first()
    return current if known == here else loaded


def reconcile_dated(store: DataFrame) -> DataFrame:
    """Drop an undated row once its source address has a dated row of the same title and place.

    Rows without an address, title or place are never reconciled.
    """
    same = {"_u": F.trim("fuente_url"), "_t": fold_text(F.col("titulo")), "_l": fold_text(F.coalesce("lugar_nombre", F.lit("")))}
    keyed = store.withColumns(same)
    dated = keyed.filter(F.col("inicio").isNotNull() & (F.col("_u") != "") & (F.col("_t") != "") & (F.col("_l") != "")).select(*same).distinct()
    waits = F.coalesce(F.col("estado") == "revisar_fecha", F.lit(False)) & F.col("inicio").isNull()
    undated = keyed.filter(waits).join(dated, list(same), "left_anti")
    return keyed.filter(~waits).select(*store.columns).unionByName(undated.select(*store.columns))


def run_trend(history: DataFrame, run: DataFrame, keep: int | None = None) -> DataFrame:
    """Append a run's KPI rows, newest first; ``keep`` leaves that many of them."""
    both = history.unionByName(run, allowMissingColumns=True)
    rest = [F.col(c) for c, t in both.dtypes if c != "momento" and not t.startswith("map")]
    ordered = both.orderBy(F.col("momento").desc(), *rest)
    return ordered if keep is None else ordered.limit(keep)


HEADER = "version string, numero bigint, generado timestamp_ntz, total bigint"
FACET = "faceta string, valor string, n bigint"


def facet_table(rows: DataFrame, facets: Sequence[str]) -> DataFrame:
    """How many rows have each filled value of each facet; a list counts each of its values."""
    kinds = dict(rows.dtypes)

    def named(c: str) -> Column:
        one = F.col(c) if kinds[c].startswith("array") else F.array(c)
        return F.transform(one, lambda v: F.struct(F.lit(c).alias("faceta"), v.cast("string").alias("valor")))

    values = [named(c) for c in facets]
    told = rows.select(F.explode(F.flatten(F.array(*[F.coalesce(v, F.array().cast("array<struct<faceta: string, valor: string>>")) for v in values]))).alias("v"))
    return told.filter("v.valor <> ''").groupBy("v.faceta", "v.valor").agg(F.count(F.lit(1)).alias("n"))


def publish_catalogue(rows: DataFrame, generated: Column, path: str, facets: Sequence[str] = ("categoria", "comuna", "publico"),
                      by: str = "formato") -> str:
    """Write a version of the catalogue: rows partitioned by ``by`` and in agenda order, facets counted, one header row.

    The header comes last and names its version, so readers see rows, facets and header change together; a version that
    was not finished is never seen. Returns the version.
    """
    spark = rows.sparkSession
    version = uuid.uuid4().hex
    order = [F.col("inicio").asc_nulls_last(), F.col("seq")]
    rows.repartitionByRange(F.col(by), *order).sortWithinPartitions(by, *order).write.partitionBy(by).parquet(f"{path}/{version}/filas")
    written = spark.read.schema(rows.schema).parquet(f"{path}/{version}/filas")
    facet_table(written, facets).write.parquet(f"{path}/{version}/facetas")
    before = headers(spark, path).agg(F.max("numero")).first()[0]
    (written.agg(F.count(F.lit(1)).alias("total")).select(
        F.lit(version).alias("version"), F.lit((before or 0) + 1).cast("bigint").alias("numero"), generated.cast("timestamp_ntz").alias("generado"), "total")
     .coalesce(1).write.mode("append").parquet(f"{path}/cabeceras"))
    return version


def headers(spark: SparkSession, path: str) -> DataFrame:
    """One row for each finished version."""
    try:
        return spark.read.schema(HEADER).parquet(f"{path}/cabeceras")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HEADER)


def read_published(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Header (one row), rows and facets of the newest version."""
    header = headers(spark, path).orderBy(F.col("numero").desc(), "version").limit(1)
    version = header.first().version
    return (header, spark.read.parquet(f"{path}/{version}/filas"), spark.read.schema(FACET).parquet(f"{path}/{version}/facetas"))


def agenda_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("inicio").asc_nulls_last(), F.col("seq"))


def split_formats(published: DataFrame) -> DataFrame:
    """Adds ``formato`` and fills weekdays of workshops; an inverted end is dropped."""
    from kermesse.functions.dates import weekdays_from_title
    from kermesse.functions.labels import is_workshop
    fixed = published.withColumn("fin", F.when(F.col("fin") < F.col("inicio"), F.lit(None)).otherwise(F.col("fin")))
    shop = fixed.withColumn("_w", is_workshop(F.col("titulo"), F.col("categoria"), F.col("fuente"),
                                              F.col("dias_semana"))["label"])
    none = F.coalesce(F.size("dias_semana"), F.lit(0)) <= 0
    read = [F.when(F.size(d) > 0, d) for d in (weekdays_from_title(F.col("titulo")),
                                               weekdays_from_title(F.col("descripcion")))]
    return shop.withColumns({
        "formato": F.when(F.col("_w"), "taller").otherwise("panorama"),
        "dias_semana": F.when(F.col("_w") & none, F.coalesce(*read, F.col("dias_semana")))
        .otherwise(F.col("dias_semana"))}).drop("_w")


def union_sources(*parts: DataFrame) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def catalogue_delta(before: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """Ids that came in (``alta``) and went out (``baja``)."""
    a, b = before.select(key).distinct(), after.select(key).distinct()
    return (b.join(a, key, "left_anti").withColumn("cambio", F.lit("alta"))
            .unionByName(a.join(b, key, "left_anti").withColumn("cambio", F.lit("baja"))))


def duplicate_ids(df: DataFrame, key: str = "id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
