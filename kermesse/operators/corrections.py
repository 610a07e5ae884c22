"""Human corrections laid over events, places and merchants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions.places import coerce_coordinate
from kermesse.functions.text import fold_text
from kermesse.operators.skew import best_row, lookup
from kermesse.vocab.places import BOX_REGION

EVENT_FIELDS = ("lugar", "direccion", "comuna", "categoria", "subcategoria", "escala", "publico")
# Characters of a key that a name must hold for the pair to be looked at.
GRAM = 8


def _grams(key: Column) -> Column:
    """All windows of the text up to ``GRAM`` characters: where a short key could start."""
    sizes = F.sequence(F.lit(1), F.lit(GRAM))
    starts = F.sequence(F.lit(1), F.greatest(F.length(key), F.lit(1)))
    return F.array_distinct(F.flatten(F.transform(sizes, lambda n: F.transform(
        starts, lambda i: F.substring(key, i, n)))))


def contained_key_matches(names: DataFrame, keys: DataFrame) -> DataFrame:
    """``names(k)`` x ``keys(clave, file_order)``: first key equal to, else contained in, the name.

    An equi-join on the first characters of each key finds the candidates, so neither side
    is multiplied by the other; containment is then checked on those pairs alone.
    """
    probes = names.select("k", F.explode(_grams(F.col("k"))).alias("g"))
    heads = keys.select("clave", "file_order", F.substring("clave", 1, GRAM).alias("g"))
    pairs = probes.join(heads, "g").filter(F.contains(F.col("k"), F.col("clave")))
    ranked = pairs.select("k", "clave", "file_order", (F.col("k") != F.col("clave")).alias("inexact"))
    return best_row(ranked, ["k"], [F.col("inexact"), F.col("file_order")]).drop("inexact")


def clean_corrections(raw: DataFrame, key: str = "clave") -> DataFrame:
    """Fold the key and keep a pin only when both coordinates are inside the region."""
    la0, la1, lo0, lo1 = BOX_REGION
    out = raw.withColumn(key, fold_text(F.col(key), "squeeze"))
    if "lat" in raw.columns:
        out = out.withColumns({"_la": coerce_coordinate(F.col("lat"), la0, la1),
                               "_lo": coerce_coordinate(F.col("lon"), lo0, lo1)})
        ok = F.col("_la").isNotNull() & F.col("_lo").isNotNull()
        out = out.withColumns({"lat": F.when(ok, F.col("_la")), "lon": F.when(ok, F.col("_lo"))}
                              ).drop("_la", "_lo")
    return out


def _overlay(df: DataFrame, prefix: str, fields, available) -> DataFrame:
    """Replace non-blank corrected fields, remember which ones changed."""
    new_cols, touched = {}, []
    for f in fields:
        if f not in available or f not in df.columns:
            continue
        c = F.col(f"{prefix}{f}")
        change = (F.coalesce(c, F.lit("")) != "") & ~F.col(f).eqNullSafe(c)
        new_cols[f] = F.when(change, c).otherwise(F.col(f))
        touched.append(F.when(change, F.lit(f)))
    if "lat" in available:
        la, lo = F.col(f"{prefix}lat"), F.col(f"{prefix}lon")
        move = la.isNotNull() & lo.isNotNull() & ~(F.col("lat").eqNullSafe(la) & F.col("lon").eqNullSafe(lo))
        new_cols |= {"lat": F.when(move, la).otherwise(F.col("lat")),
                     "lon": F.when(move, lo).otherwise(F.col("lon")),
                     "precision": F.when(move, "correccion").otherwise(F.col("precision"))}
        touched.append(F.when(move, F.lit("coordenadas")))
    new_cols["tocados"] = F.concat(F.col("tocados"), F.array_compact(F.array(*touched)))
    return df.withColumns(new_cols)


def overlay_place_corrections(events: DataFrame, places: DataFrame) -> DataFrame:
    """Place corrections by exact folded name, else by the first contained key."""
    base = events if "tocados" in events.columns else events.withColumn(
        "tocados", F.array().cast("array<string>"))
    base = base.withColumn("_k", fold_text(F.col("lugar"), "squeeze"))
    clean = clean_corrections(places)
    found = contained_key_matches(base.select(F.col("_k").alias("k")).filter("k != ''").distinct(), clean)
    fields = [c for c in clean.columns if c not in ("clave", "file_order", "nota")]
    fixes = found.select("k", "clave").join(clean, "clave").select(
        F.col("k").alias("_k"), *[F.col(c).alias(f"p_{c}") for c in fields])
    joined = lookup(base, fixes, ["_k"])
    return _overlay(joined, "p_", EVENT_FIELDS, fields).select(*base.drop("_k").columns)


def overlay_event_corrections(events: DataFrame, fixes: DataFrame) -> DataFrame:
    """Corrections of single events by id, applied after the place ones; ``descartar`` drops."""
    base = events if "tocados" in events.columns else events.withColumn(
        "tocados", F.array().cast("array<string>"))
    clean = clean_corrections(fixes, "id")
    fields = [c for c in clean.columns if c not in ("id", "nota")]
    joined = base.join(clean.select("id", *[F.col(c).alias(f"e_{c}") for c in fields]), "id", "left")
    if "descartar" in fields:
        joined = joined.filter(~F.coalesce(F.col("e_descartar"), F.lit(False)))
    return _overlay(joined, "e_", EVENT_FIELDS, fields).select(*base.columns)


def overlay_merchant_corrections(offers: DataFrame, fixes: DataFrame) -> DataFrame:
    """Exact merchant name only. Cuisine and rubric always; the address only when the issuer gave none."""
    clean = clean_corrections(fixes)
    fields = [c for c in clean.columns if c not in ("clave", "nota")]
    base = offers.withColumns({"clave": fold_text(F.col("comercio"), "squeeze"),
                               "tocados": F.array().cast("array<string>")})
    joined = lookup(base, clean.select("clave", *[F.col(c).alias(f"m_{c}") for c in fields]), ["clave"])
    no_address = F.coalesce(F.col("direccion"), F.lit("")) == ""
    site = F.when((F.coalesce(F.col("sitio_web"), F.lit("")) == "")
                  & (F.coalesce(F.col("m_sitio_web"), F.lit("")) != ""), F.col("m_sitio_web")) \
        if "sitio_web" in fields else F.lit(None).cast("string")
    always = _overlay(joined, "m_", ("cocina", "categoria"), [f for f in fields if f not in ("lat", "lon")])
    always = always.withColumns({
        "tocados": F.when(site.isNotNull(), F.array_append("tocados", F.lit("sitio_web"))).otherwise(F.col("tocados")),
        "sitio_web": F.coalesce(site, F.col("sitio_web"))})
    for f in ("direccion", "comuna", "lat", "lon"):
        if f in fields:
            always = always.withColumn(f"m_{f}", F.when(no_address, F.col(f"m_{f}")))
    return _overlay(always, "m_", ("direccion", "comuna"), fields).select(*offers.columns, "tocados")


def correction_problems(raw: DataFrame, allowed, name: str, key: str = "clave") -> DataFrame:
    """Unknown fields, bad pins and non-text keys of a correction table, as warnings."""
    extra = [c for c in raw.columns if c not in (*allowed, key, "file_order")]
    la0, la1, lo0, lo1 = BOX_REGION
    problems = [F.when(F.col(c).isNotNull(), F.lit(f"campo desconocido: {c}")) for c in extra]
    if "lat" in raw.columns and "lon" in raw.columns:
        given = F.col("lat").isNotNull() | F.col("lon").isNotNull()
        bad = coerce_coordinate(F.col("lat"), la0, la1).isNull() | coerce_coordinate(F.col("lon"), lo0, lo1).isNull()
        problems.append(F.when(given & bad, F.lit("coordenadas invalidas")))
    problems.append(F.when(F.col(key).cast("string").rlike(r"^\d+$"), F.lit("clave numerica")))
    return raw.select(F.lit("aviso").alias("level"), F.lit(f"correcciones:{name}").alias("check"),
                      F.col(key).cast("string").alias("key"),
                      F.explode(F.array_compact(F.array(*problems))).alias("detail"))
