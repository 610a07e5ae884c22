"""The merchant-offer table: homologation, lending, dedup, facets, run state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions import offers as fn
from kermesse.functions.places import merchant_key
from kermesse.functions.text import offer_key
from kermesse.operators.filters import offer_alive
from kermesse.operators.skew import best_row, lookup


def homologate(offers: DataFrame) -> DataFrame:
    """Single rubric vocabulary, deduced cuisine, whole coordinates."""
    raw = F.col("categoria")
    cuisine = F.when(F.coalesce("cocina", F.lit("")) != "", F.col("cocina")).otherwise(
        fn.cuisine_of(F.col("comercio"), raw))
    whole = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return offers.withColumn("cocina", cuisine).withColumns({
        "categoria": fn.rubric_of(raw, F.col("cocina")),
        "lat": F.when(whole, F.col("lat")), "lon": F.when(whole, F.col("lon"))})


def with_id(offers: DataFrame, by_address: bool = False) -> DataFrame:
    return offers.withColumn("id", offer_key(
        F.col("banco_id"), F.col("comercio"), F.col("comuna"),
        F.col("direccion") if by_address else None))


def lend_addresses(offers: DataFrame) -> DataFrame:
    """Same merchant at another issuer: the first row that knows the address lends it.

    Exact folded names only. ``seq`` decides which row is first.
    """
    has = (F.coalesce("direccion", F.lit("")) != "") & (F.coalesce("comuna", F.lit("")) != "")
    keyed = offers.withColumn("_k", merchant_key(F.col("comercio")))
    donors = keyed.filter(has).groupBy("_k").agg(
        F.min(F.struct("seq", "direccion", "comuna", "lat", "lon", "banco")).alias("_d"))
    out = lookup(keyed, donors, ["_k"])
    borrow = (F.coalesce("direccion", F.lit("")) == "") & F.col("_d").isNotNull()
    no_pin = borrow & F.col("lat").isNull()
    changed = {
        "direccion": F.when(borrow, F.col("_d.direccion")).otherwise(F.col("direccion")),
        "comuna": F.when(borrow, F.col("_d.comuna")).otherwise(F.col("comuna")),
        "lat": F.when(no_pin, F.col("_d.lat")).otherwise(F.col("lat")),
        "lon": F.when(no_pin, F.col("_d.lon")).otherwise(F.col("lon")),
        "direccion_prestada_de": F.when(borrow, F.col("_d.banco")).otherwise(F.col("direccion_prestada_de")),
    }
    return out.select(*[changed.get(c, F.col(c)).alias(c) for c in offers.columns])


def richness() -> Column:
    """How much a row can answer: days weigh 4, a percentage 2, label and expiry 1 each."""
    return ((F.coalesce(F.size("dias"), F.lit(0)) > 0).cast("int") * 4
            + F.col("porcentaje").isNotNull().cast("int") * 2
            + (F.coalesce("oferta", F.lit("")) != "").cast("int")
            + F.col("vigencia_hasta").isNotNull().cast("int"))


def dedup_keep_richest(offers: DataFrame) -> DataFrame:
    """One row per id: the richest, the first on a tie."""
    return best_row(offers, ["id"], [-richness(), F.col("seq")])


def offer_value_order(offers: DataFrame) -> DataFrame:
    return offers.orderBy(-F.coalesce("porcentaje", F.lit(0)), F.lower("comercio"), "banco", "id")


def bank_stats(offers: DataFrame, as_of: Column) -> DataFrame:
    """Raw, usable, dated, expired and out-of-region counts per issuer."""
    alive = offer_alive(F.col("vigencia_hasta"), as_of)
    named = F.coalesce("comercio", F.lit("")) != ""
    here = fn.in_region(F.col("comuna"), F.col("region"))
    usable = alive & named & here
    return offers.groupBy("banco").agg(
        F.count(F.lit(1)).alias("crudos"), F.count_if(usable).alias("vigentes"),
        F.count_if(usable & (F.size("dias") > 0)).alias("con_dia"),
        F.count_if(~alive).alias("vencidos"), F.count_if(alive & named & ~here).alias("fuera_rm"))


def day_histogram(offers: DataFrame) -> DataFrame:
    return offers.select(F.explode("dias").alias("dia")).groupBy("dia").agg(F.count(F.lit(1)).alias("n"))


def facet_values(offers: DataFrame) -> DataFrame:
    """Distinct banks and areas as ``(facet, value)`` rows."""
    banks = offers.select(F.lit("banco").alias("facet"), F.col("banco").alias("value"))
    areas = offers.filter(F.coalesce("comuna", F.lit("")) != "").select(
        F.lit("comuna").alias("facet"), F.col("comuna").alias("value"))
    return banks.unionByName(areas).distinct().orderBy("facet", "value")


def top_areas(offers: DataFrame, k: int = 15) -> DataFrame:
    return (offers.filter(F.coalesce("comuna", F.lit("")) != "").groupBy("comuna")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "comuna").limit(k))


def bank_run_state(banks: DataFrame, stats: DataFrame, known=None) -> DataFrame:
    """Configured issuers with their run numbers; a missing one says so."""
    out = banks.select("banco", "adaptador").join(
        stats.withColumn("_ran", F.lit(True)), "banco", "left")
    ran = F.coalesce(F.col("_ran"), F.lit(False))
    err = F.col("error") if "error" in stats.columns else F.lit("")
    error = F.coalesce(F.when(err != "", err), F.when(~ran, F.concat(
        F.lit("adaptador desconocido: "), F.coalesce("adaptador", F.lit("")))), F.lit(""))
    return out.select("banco", "adaptador", ran.alias("corrio"), *[
        F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("crudos", "vigentes", "con_dia", "vencidos", "fuera_rm")],
        error.alias("error"))


def capture_age_alert(offers: DataFrame, banks: DataFrame, as_of: Column) -> DataFrame:
    """Issuers whose hand capture is older than their limit of days."""
    newest = offers.groupBy("banco").agg(F.min(F.struct("seq", "capturado"))["capturado"].alias("capturado"))
    age = F.datediff(as_of.cast("date"), F.col("capturado").try_cast("date"))
    return (newest.join(banks.select("banco", "avisar_dias"), "banco")
            .withColumn("dias", age).filter(F.col("dias") > F.col("avisar_dias")))
