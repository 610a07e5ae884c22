"""Hand-made inputs: CSV files, curated entries, pasted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions.dates import parse_date_es
from kermesse.functions.money import parse_price_clp
from kermesse.functions.places import detect_area
from kermesse.functions.text import summarise, unescape
from kermesse.sources.captures import as_candidates, order_number
from kermesse.vocab.labels import MAX_PRICE_CLP

# Default CSV column of each field.
CSV_COLUMNS = {
    "titulo": "nombre", "categoria": "categoria", "inicio": "fecha_inicio", "hora_inicio": "hora_inicio",
    "fin": "fecha_termino", "lugar_nombre": "lugar", "comuna": "comuna", "precio_clp": "precio_min",
    "fuente_url": "link_evento", "imagen_url": "imagen_recorte", "id_externo": "id", "fuente_nombre": "fuente_nombre",
}
# Sales status words of a pasted table.
STATUS_WORDS = ("sold out", "agotado", "promo", "funciones disponibles", "cancelado")


def read_csv(spark, path: str) -> DataFrame:
    """CSV files with a header, all text, with the name of the file each row came from."""
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
            .withColumn("archivo", F.col("_metadata.file_name")))


def map_csv(rows: DataFrame, as_of: Column, columns: dict[str, str] | None = None, source: str = "",
            area: str = "") -> DataFrame:
    """Candidates from CSV rows; price ``0`` means free, the source falls back to the file name."""
    names = {**CSV_COLUMNS, **(columns or {})}

    def col(field: str) -> Column:
        name = names.get(field)
        return unescape(F.trim(F.coalesce(F.col(name), F.lit("")))) if name in rows.columns else F.lit("")

    hour = col("hora_inicio")
    when = F.when((col("inicio") != "") & (hour != ""), F.concat_ws(" ", col("inicio"), F.substring(hour, 1, 5))
                  ).otherwise(col("inicio"))
    amount = col("precio_clp").try_cast("double").cast("int")
    stem = F.initcap(F.replace(F.regexp_replace("archivo", r"\.[^.]*$", ""), F.lit("_"), F.lit(" "))) \
        if "archivo" in rows.columns else F.lit("")
    named = F.coalesce(*[F.when(c != "", c) for c in (col("fuente_nombre"), F.lit(source), stem)], F.lit(""))
    out = rows.select(
        F.col("seq") if "seq" in rows.columns else F.monotonically_increasing_id().alias("seq"),
        col("titulo").alias("titulo"), col("categoria").alias("categoria"),
        parse_date_es(when, as_of).alias("inicio"), parse_date_es(col("fin"), as_of).alias("fin"),
        col("lugar_nombre").alias("lugar_nombre"), detect_area(col("comuna"), col("lugar_nombre"), F.lit(area)).alias("comuna"),
        F.when(amount.between(1, MAX_PRICE_CLP), amount).alias("precio_clp"),
        F.when(amount == 0, F.lit(True)).alias("es_gratis"), F.lit("manual").alias("fuente_tipo"),
        named.alias("fuente_nombre"), col("fuente_url").alias("fuente_url"), col("fuente_url").alias("link_entradas"),
        col("imagen_url").alias("imagen_url"), col("id_externo").alias("id_externo"))
    return as_candidates(out.filter("titulo != '' and fuente_url != ''"))


def read_curated_entries(files: DataFrame, as_of: Column, source: str = "Ingesta manual", area: str = "") -> DataFrame:
    """Entries of JSON files ``(archivo, contenido)``; files named with a leading ``_`` are notes."""
    v = F.try_parse_json(F.col("contenido"))
    listed = F.coalesce(F.try_variant_get(v, "$.eventos", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"))
    rows = files.filter(~F.col("archivo").startswith("_")).select("seq", F.posexplode(listed).alias("pos", "e"))
    text = lambda k: F.trim(F.coalesce(F.try_variant_get("e", f"$.{k}", "string"), F.lit("")))
    said = parse_price_clp(text("precio_texto"))
    price, free = F.try_variant_get("e", "$.precio_clp", "string").try_cast("int"), F.try_variant_get("e", "$.es_gratis", "boolean")
    silent = F.try_variant_get("e", "$.precio_clp", "string").isNull() & free.isNull()
    rows = rows.filter((text("titulo") != "") & (text("fuente_url") != "")).withColumn("_s", said)
    return as_candidates(rows.select(
        order_number(F.col("seq"), F.col("pos")).alias("seq"), text("titulo").alias("titulo"),
        text("categoria").alias("categoria"), summarise(text("descripcion_corta")).alias("descripcion_corta"),
        parse_date_es(text("inicio"), as_of).alias("inicio"), parse_date_es(text("fin"), as_of).alias("fin"),
        text("lugar_nombre").alias("lugar_nombre"), text("lugar_direccion").alias("lugar_direccion"),
        detect_area(text("comuna"), text("lugar_direccion"), text("lugar_nombre"), F.lit(area)).alias("comuna"),
        F.when(silent, F.col("_s.price")).otherwise(price).alias("precio_clp"),
        F.when(silent, F.col("_s.free")).otherwise(free).alias("es_gratis"), text("precio_texto").alias("precio_texto"),
        F.lit("manual").alias("fuente_tipo"),
        F.when(text("fuente_nombre") != "", text("fuente_nombre")).otherwise(F.lit(source)).alias("fuente_nombre"),
        text("fuente_url").alias("fuente_url"), text("link_entradas").alias("link_entradas"),
        text("imagen_url").alias("imagen_url"), text("id_externo").alias("id_externo")))


def read_pasted_table(lines: DataFrame, as_of: Column, source: str,
                      order: tuple[str, ...] = ("fecha", "hora", "evento", "lugar", "estado", "link")) -> DataFrame:
    """Rows of a tab- or pipe-separated table pasted as text lines ``(seq, value)``."""
    line = F.trim("value")
    cells = F.filter(F.transform(F.when(F.contains(line, F.lit("\t")), F.split(line, "\t"))
                                 .when(F.contains(line, F.lit("|")), F.split(line, r"\|")), lambda x: F.trim(x)), lambda c: c != "")
    rows = lines.withColumn("c", cells).filter(F.size("c") >= 3)
    flat = F.lower(F.array_join("c", " "))
    rows = rows.filter(~flat.rlike(r"^[-: |]*$") & ~(flat.startswith("fecha") & F.contains(flat, F.lit("evento"))))
    at = lambda k: F.coalesce(F.get("c", F.lit(order.index(k))), F.lit("")) if k in order else F.lit("")
    when = F.when(F.contains(at("hora"), F.lit(":")), F.concat_ws(" ", at("fecha"), at("hora"))).otherwise(at("fecha"))
    tail = F.concat(F.lit("/ "), at("lugar"))
    title = F.when((at("lugar") != "") & F.endswith(at("evento"), tail), F.trim(F.expr("left(_e, length(_e) - length(_tail))"))
                   ).otherwise(at("evento"))
    rows = rows.withColumns({"_e": at("evento"), "_tail": tail}).withColumns({
        "titulo": title, "inicio": parse_date_es(when, as_of)})
    return as_candidates(rows.filter("inicio is not null and titulo != ''").select(
        "seq", "titulo", F.when(F.lower(at("estado")).isin(*STATUS_WORDS), at("estado")).otherwise("").alias("descripcion_corta"),
        "inicio", at("lugar").alias("lugar_nombre"), detect_area(at("lugar")).alias("comuna"),
        F.lit("manual").alias("fuente_tipo"), F.lit(source).alias("fuente_nombre"), at("link").alias("fuente_url")))
