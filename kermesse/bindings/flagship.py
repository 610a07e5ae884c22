"""The runs end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kermesse.bindings import inputs as i
from kermesse.bindings.joins import CATALOGUE, catalogue
from kermesse.bindings.registry import register
from kermesse.bindings.tables import COLLAPSED, FMT, KEYED, stamp
from kermesse.operators import review
from kermesse.plans import agenda, publish
from kermesse.schemas import STORE
from kermesse.session import ensure_checkpoint_dir

CONFIG = "fuente_nombre string, colapsar boolean, requiere_comuna boolean, filtro_palabras array<string>, descartar_palabras array<string>"


def _config(spark, sf):
    """One row per source, as many as the table names."""
    return i.candidates(spark, sf).select("fuente_nombre").distinct().selectExpr(
        "fuente_nombre", "fuente_nombre <> 'purchase' AS colapsar", "fuente_nombre = 'view' AS requiere_comuna",
        "CASE WHEN fuente_nombre = 'signup' THEN array('1', '2', '3') END AS filtro_palabras", "CASE WHEN fuente_nombre = 'click' THEN array('6') END AS descartar_palabras")


RUN = f"""{COLLAPSED}, merged AS (SELECT m.seq, c.titulo, m.inicio, CASE WHEN n > 1 THEN ultimo ELSE fin0 END AS fin, c.lugar_nombre, c.comuna, c.fuente_nombre, c.fuente_url, c.descripcion_corta
  FROM m JOIN cand c USING (seq) WHERE c.fuente_nombre <> 'purchase' UNION ALL SELECT seq, titulo, inicio, fin, lugar_nombre, comuna, fuente_nombre, fuente_url, descripcion_corta FROM cand WHERE fuente_nombre = 'purchase'),
gated AS (SELECT *, CASE WHEN fuente_url = '' THEN 'u' WHEN fuente_url NOT LIKE 'http%' THEN 'h' WHEN fuente_url LIKE '%/api/%' THEN 'a' WHEN CAST(coalesce(fin, inicio) AS date) < DATE '2024-01-15' THEN 'p'
  WHEN fuente_nombre = 'view' AND comuna = '' THEN 'c' WHEN fuente_nombre = 'click' AND (titulo LIKE '% 6' OR descripcion_corta = 'nota 6') THEN 'x'
  WHEN fuente_nombre = 'signup' AND NOT (regexp_matches(titulo, ' [123]$') OR descripcion_corta IN ('nota 1', 'nota 2', 'nota 3')) THEN 'f' END AS motivo FROM merged),
kept AS (SELECT substr(sha1(concat(titulo, '|', strftime(inicio, '%Y-%m-%d'), '|', lower(lugar_nombre))), 1, 16) AS hash_dedup, last(titulo ORDER BY seq) AS titulo, last(inicio ORDER BY seq) AS inicio, last(fin ORDER BY seq) AS fin,
  last(lugar_nombre ORDER BY seq) AS lugar FROM gated WHERE motivo IS NULL GROUP BY 1)"""


def _run(spark, sf, materialise=False):
    empty = spark.createDataFrame([], STORE)
    return agenda.daily_run(empty, i.candidates(spark, sf), _config(spark, sf), i.as_of(), i.now(), materialise)


def whats_on_this_weekend(spark, sf):
    out = agenda.whats_on(_run(spark, sf)["store"], "finde", i.as_of())
    return out.select("hash_dedup", "titulo", stamp("inicio").alias("inicio"), stamp("fin").alias("fin"), F.col("lugar_nombre").alias("lugar"))


@register("p01_weekend_agenda", f"""WITH {RUN} SELECT hash_dedup, titulo, strftime(inicio, {FMT}) AS inicio, strftime(fin, {FMT}) AS fin, lugar FROM kept
  WHERE CAST(inicio AS date) <= DATE '2024-01-21' AND CAST(CASE WHEN fin > inicio THEN fin ELSE inicio END AS date) >= DATE '2024-01-19'""")
def p01(spark, sf):
    return whats_on_this_weekend(spark, sf)


@register("p01_daily_run_counts", f"""WITH {RUN}, r AS (SELECT fuente_nombre, count(*) FILTER (motivo IS NOT NULL) AS descartados, count(DISTINCT CASE WHEN motivo IS NULL THEN concat(titulo, CAST(inicio AS date), lugar_nombre) END) AS nuevos FROM gated GROUP BY 1)
  SELECT fuente_nombre, nuevos + descartados AS encontrados, nuevos, 0 AS actualizados, descartados FROM r""")
def p01b(spark, sf):
    return _run(spark, sf, materialise=True)["counts"]


@register("p01_run_log", f"""WITH {RUN}, r AS (SELECT fuente_nombre, count(*) FILTER (motivo IS NOT NULL) AS descartados, count(DISTINCT CASE WHEN motivo IS NULL THEN concat(titulo, CAST(inicio AS date), lugar_nombre) END) AS nuevos FROM gated GROUP BY 1)
  SELECT fuente_nombre AS fuente, CAST(nuevos + descartados AS int) AS encontrados, CAST(nuevos AS int) AS nuevos, CAST(descartados AS int) AS descartados, '' AS error FROM r""")
def p01c(spark, sf):
    """A run writes its log; the newest run of each source is read back from it."""
    path = f"{ensure_checkpoint_dir(spark)}/log-{uuid.uuid4().hex}"
    rows = review.run_log(_run(spark, sf, materialise=True)["counts"], i.now())
    log = review.append_run_log(rows, path)
    return review.latest_run_per_source(log, i.now().cast("date")).select("fuente", "encontrados", "nuevos", "descartados", "error")


# Rows of the store with an address each, located on the street of its nation by the nearest number within 250.
ADDRESS = {"spark": "conv(substring(hash_dedup, 1, 4), 16, 10) % 25", "duck": "('0x' || substr(hash_dedup, 1, 4))::int % 25"}
NUMBER = {"spark": "conv(substring(hash_dedup, 5, 4), 16, 10) % 900", "duck": "('0x' || substr(hash_dedup, 5, 4))::int % 900"}
PUBLISHED = f"""WITH {KEYED.replace('last(lat ORDER BY seq) FILTER (lat IS NOT NULL) AS lat', 'last(lat ORDER BY seq) FILTER (lat IS NOT NULL) AS lat, last(lon ORDER BY seq) FILTER (lon IS NOT NULL) AS lon0')}, {CATALOGUE},
cur AS (SELECT *, 'avenida building n' || {ADDRESS['duck']} AS calle, {NUMBER['duck']} AS numero_q, lon0 AS lon FROM stored
  WHERE CAST(coalesce(fin, inicio) AS date) >= DATE '2024-01-15' AND estado <> 'descartado' AND fuente_url NOT LIKE '%/api/%'),
near AS (SELECT hash_dedup, cat.lat AS la, cat.lon AS lo, row_number() OVER (PARTITION BY hash_dedup ORDER BY abs(cat.numero - numero_q), ciudad, cat.lat, cat.lon) AS rn FROM cur JOIN cat USING (calle) WHERE abs(cat.numero - numero_q) < 250 QUALIFY rn = 1),
pin AS (SELECT cur.*, CASE WHEN cur.lat IS NULL THEN CASE WHEN la IS NULL THEN 'sin_ubicar' ELSE 'calle' END
  WHEN sqrt(power((cur.lat - la) * 111, 2) + power((cur.lon - lo) * 92, 2)) > 1 THEN 'calle' ELSE 'fuente' END AS precision FROM cur LEFT JOIN near USING (hash_dedup)),
g AS (SELECT *, count(*) OVER w AS n, bool_or(fin IS NOT NULL) OVER w AS ended, row_number() OVER (PARTITION BY titulo, lugar_nombre, strftime(inicio, '%H:%M') ORDER BY inicio, hash_dedup) AS rn
  FROM pin WINDOW w AS (PARTITION BY titulo, lugar_nombre, strftime(inicio, '%H:%M'))),
card AS (SELECT *, n >= 3 AND NOT ended AS serie FROM g WHERE NOT (n >= 3 AND NOT ended) OR rn = 1),
shared AS (SELECT round_even(lat, 4) AS la, round_even(lon, 4) AS lo FROM card WHERE precision = 'fuente' GROUP BY 1, 2 HAVING min(lugar_nombre) <> max(lugar_nombre))
SELECT CASE WHEN serie THEN 'taller' ELSE 'panorama' END AS formato, 'otros' AS categoria, CASE WHEN precision = 'fuente' AND shared.la IS NOT NULL THEN 'comuna' ELSE precision END AS precision, count(*) AS n
FROM card LEFT JOIN shared ON round_even(lat, 4) = shared.la AND round_even(card.lon, 4) = shared.lo GROUP BY ALL"""


@register("p03_publish_catalogue", PUBLISHED)
def p03(spark, sf):
    """Labels, corrections, pins, series and formats over the whole store, counted by label."""
    street = F.concat(F.lit("Av. Building N"), F.expr(f"cast(cast({ADDRESS['spark']} as int) as string)"), F.lit(" # "), F.expr(f"cast(cast({NUMBER['spark']} as int) as string)"))
    store = i.store_rows(spark, sf).withColumn("lugar_direccion", street)
    out = publish.publish(store, i.as_of(), catalogue(spark, sf))
    return out.groupBy("formato", "categoria", "precision").agg(F.count(F.lit(1)).alias("n"))
