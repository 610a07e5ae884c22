"""The library's input tables derived from the given ones, each with the same SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.bindings.registry import table
from kermesse.schemas import CANDIDATE, OFFER, conform

AS_OF_TEXT = "2024-01-15"


def as_of():
    return F.lit(AS_OF_TEXT).cast("date")


def now():
    return F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")


# Candidate events. Every column is an expression valid in both engines.
CAND_COLS = {
    "seq": "event_id",
    "titulo": "concat(event_type, ' ', cast(user_id % 7 as string))",
    "categoria": "''",
    "descripcion_corta": "concat('nota ', cast(user_id as string))",
    "inicio": "ts",
    "fin": "case when event_id % 11 = 0 then ts + interval '3' day end",
    "todo_el_dia": "false",
    "lugar_nombre": "concat('Sala ', {k})",
    "lugar_direccion": "''",
    "comuna": "case when user_id % 5 = 0 then '' else concat('Zona ', cast(user_id % 5 as string)) end",
    "lat": "case when event_id % 4 = 0 then null else -33.4 - (user_id % 10) / 100.0e0 end",
    "lon": "case when event_id % 4 = 0 then null else -70.6 - (user_id % 7) / 100.0e0 end",
    "precio_clp": "case when event_id % 3 = 0 then null else cast(floor(value * 1000) as int) end",
    "es_gratis": "case when event_id % 3 = 0 then null else user_id % 4 = 0 end",
    "precio_texto": "case when event_id % 5 < 3 then '' else concat('desde ', cast(event_id as string)) end",
    "fuente_tipo": "'json'",
    "fuente_nombre": "event_type",
    "fuente_url": ("case when event_id % 13 = 0 then '' when event_id % 17 = 0 then concat('ftp://x.cl/', cast(event_id as string)) "
                   "when event_id % 19 = 0 then concat('https://x.cl/api/', cast(event_id as string)) "
                   "else concat('https://x.cl/e/', cast(event_id as string)) end"),
    "link_entradas": "''",
    "imagen_url": "case when event_id % 6 = 0 then '' else concat('https://x.cl/i/', cast(event_id as string)) end",
    "id_externo": "cast(event_id as string)",
}


def _cand_sql(k: str, text: str) -> str:
    return ", ".join(f"{e.replace('{k}', k).replace('as string', 'as ' + text)} AS {n}" for n, e in CAND_COLS.items())


DUCK_K = "json_extract_string(props, '$.k')"
SPARK_K = "get_json_object(props, '$.k')"
CAND = f"cand AS (SELECT {_cand_sql(DUCK_K, 'varchar')} FROM events)"


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").selectExpr(*[
        f"{e.replace('{k}', SPARK_K)} AS {n}" for n, e in CAND_COLS.items()])
    return conform(rows, CANDIDATE)


# Published rows: labels by event type, pins of three kinds.
PUB = CAND + """, pub AS (SELECT seq, seq AS id, titulo, inicio, fin, lugar_nombre AS lugar,
  CASE WHEN seq % 9 = 0 THEN '' ELSE concat('Calle ', cast(seq % 50 AS varchar)) END AS direccion, comuna, lat, lon,
  CASE WHEN lat IS NULL THEN CASE WHEN seq % 8 = 0 THEN 'comuna' ELSE 'sin_ubicar' END
       WHEN seq % 5 = 0 THEN 'recinto' ELSE 'fuente' END AS precision,
  coalesce(es_gratis, false) AS gratis, precio_clp AS precio, imagen_url AS imagen,
  CASE fuente_nombre WHEN 'view' THEN 'otros' WHEN 'signup' THEN 'clases' WHEN 'purchase' THEN 'feria'
       WHEN 'click' THEN 'musica' ELSE 'deporte' END AS categoria,
  CASE WHEN seq % 10 = 0 THEN 'ninos' WHEN seq % 10 = 1 THEN 'adultos' WHEN seq % 10 = 2 THEN 'adolescentes' ELSE 'todos' END AS publico,
  descripcion_corta AS descripcion, fuente_nombre AS fuente, fuente_url AS url FROM cand)"""


def published(spark: SparkSession, sf: str) -> DataFrame:
    c = candidates(spark, sf)
    return c.selectExpr(
        "seq", "seq AS id", "titulo", "inicio", "fin", "lugar_nombre AS lugar",
        "CASE WHEN seq % 9 = 0 THEN '' ELSE concat('Calle ', cast(seq % 50 AS string)) END AS direccion", "comuna", "lat", "lon",
        "CASE WHEN lat IS NULL THEN CASE WHEN seq % 8 = 0 THEN 'comuna' ELSE 'sin_ubicar' END WHEN seq % 5 = 0 THEN 'recinto' "
        "ELSE 'fuente' END AS precision", "coalesce(es_gratis, false) AS gratis", "precio_clp AS precio", "imagen_url AS imagen",
        "CASE fuente_nombre WHEN 'view' THEN 'otros' WHEN 'signup' THEN 'clases' WHEN 'purchase' THEN 'feria' "
        "WHEN 'click' THEN 'musica' ELSE 'deporte' END AS categoria",
        "CASE WHEN seq % 10 = 0 THEN 'ninos' WHEN seq % 10 = 1 THEN 'adultos' WHEN seq % 10 = 2 THEN 'adolescentes' ELSE 'todos' END AS publico",
        "descripcion_corta AS descripcion", "fuente_nombre AS fuente", "fuente_url AS url")


# The event store: one upsert of every candidate, then mixed states.
def store_rows(spark: SparkSession, sf: str, until: str | None = None) -> DataFrame:
    """A store built by one upsert of the candidates, with mixed states."""
    from kermesse.operators.store import upsert_events
    from kermesse.schemas import STORE as DDL
    c = candidates(spark, sf)
    if until:
        c = c.filter(F.col("inicio") < F.lit(until).cast("timestamp_ntz"))
    empty = spark.createDataFrame([], DDL)
    out = upsert_events(empty, c, F.lit("2024-01-10 09:00:00").cast("timestamp_ntz")).drop("resultado")
    number = F.col("id_externo").cast("bigint") % 4
    return out.withColumn("estado", F.when(number == 0, "borrador").when(number == 1, "publicado")
                          .when(number == 2, "caducado").otherwise("descartado"))


STORED = CAND + """, keyed AS (SELECT *, substr(sha1(concat(titulo, '|', strftime(inicio, '%Y-%m-%d'), '|', lower(lugar_nombre))), 1, 16) AS hash_dedup FROM cand),
stored AS (SELECT hash_dedup, max_by(titulo, seq) AS titulo, max_by(inicio, seq) AS inicio, arg_max_null(fin, seq) AS fin,
  max_by(lugar_nombre, seq) AS lugar_nombre, max_by(comuna, seq) AS comuna, max_by(fuente_nombre, seq) AS fuente_nombre,
  arg_max_null(es_gratis, seq) AS es_gratis, arg_max_null(precio_clp, seq) AS precio_clp, max_by(fuente_url, seq) AS fuente_url,
  min(seq) AS seq0, max(seq) AS seq1, arg_max(lat, seq) AS lat,
  CASE min(seq) % 4 WHEN 0 THEN 'borrador' WHEN 1 THEN 'publicado' WHEN 2 THEN 'caducado' ELSE 'descartado' END AS estado
  FROM keyed GROUP BY hash_dedup)"""


# Offers: one row per line of an order, bank = brand, merchant = part name, area by supplier nation.
OFFER_AREA = "CASE s_nationkey % 5 WHEN 0 THEN 'Santiago' WHEN 1 THEN 'Providencia' WHEN 2 THEN 'Talca' WHEN 3 THEN '' ELSE 'Ñuñoa' END"
# A line has no key of its own: its order number is a hash of its four keys.
LINE_KEY = "concat_ws('|', cast(l_orderkey as {t}), cast(l_linenumber as {t}), cast(l_partkey as {t}), cast(l_suppkey as {t}))"
OFFERS = f"""offers AS (SELECT cast('0x' || substr(md5({LINE_KEY.format(t='varchar')}), 1, 15) as bigint) AS seq, p_brand AS banco_id, p_brand AS banco, p_name AS comercio,
  {OFFER_AREA} AS comuna, CASE s_nationkey % 4 WHEN 0 THEN 'Metropolitana' WHEN 1 THEN 'Valparaíso' ELSE '' END AS region,
  CASE WHEN l_linenumber = 1 THEN concat('Calle ', cast(s_suppkey AS varchar)) ELSE '' END AS direccion,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END AS porcentaje,
  CASE WHEN p_size % 4 = 0 THEN '2x1' ELSE '' END AS oferta,
  CASE WHEN l_quantity % 3 = 0 THEN NULL ELSE CAST(l_shipdate AS date) END AS vigencia_hasta,
  CASE WHEN l_quantity % 2 = 0 THEN [] WHEN l_quantity % 5 = 0 THEN ['martes', 'jueves'] ELSE ['viernes'] END AS dias,
  CASE WHEN l_linenumber = 1 THEN 'fuente' WHEN l_linenumber = 2 THEN 'comuna' ELSE '' END AS precision,
  CASE WHEN l_linenumber = 1 THEN -33.4e0 END AS lat, CASE WHEN l_linenumber = 1 THEN -70.6e0 END AS lon
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


def offers(spark: SparkSession, sf: str) -> DataFrame:
    line, part, supp = (table(spark, sf, t) for t in ("lineitem", "part", "supplier"))
    j = line.join(part, line.l_partkey == part.p_partkey).join(supp, line.l_suppkey == supp.s_suppkey)
    rows = j.selectExpr(
        f"cast(conv(substring(md5({LINE_KEY.format(t='string')}), 1, 15), 16, 10) as bigint) AS seq",
        "p_brand AS banco_id", "p_brand AS banco", "p_name AS comercio", "'restaurantes' AS categoria", "'' AS cocina",
        f"{OFFER_AREA} AS comuna",
        "CASE s_nationkey % 4 WHEN 0 THEN 'Metropolitana' WHEN 1 THEN 'Valparaíso' ELSE '' END AS region",
        "CASE WHEN l_linenumber = 1 THEN concat('Calle ', cast(s_suppkey AS string)) ELSE '' END AS direccion",
        "CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END AS porcentaje", "CASE WHEN p_size % 4 = 0 THEN '2x1' ELSE '' END AS oferta",
        "CASE WHEN l_quantity % 3 = 0 THEN NULL ELSE CAST(l_shipdate AS date) END AS vigencia_hasta",
        "CASE WHEN l_quantity % 2 = 0 THEN array() WHEN l_quantity % 5 = 0 THEN array('martes', 'jueves') ELSE array('viernes') END AS dias",
        "CASE WHEN l_linenumber = 1 THEN 'fuente' WHEN l_linenumber = 2 THEN 'comuna' ELSE '' END AS precision",
        "CASE WHEN l_linenumber = 1 THEN -33.4D END AS lat", "CASE WHEN l_linenumber = 1 THEN -70.6D END AS lon",
        "'' AS direccion_prestada_de", "'' AS sitio_web", "'' AS condiciones")
    return conform(rows, OFFER + ", seq bigint")


OFFER_AS_OF = "1998-06-15"
