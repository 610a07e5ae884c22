"""Collapsing, aggregation, windows, ordering, set operations and the store."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kermesse.bindings import inputs as i
from kermesse.bindings.registry import register, table
from kermesse.operators import collapse, discover, review, skew, store
from kermesse.operators import offers as off
from kermesse.session import ensure_checkpoint_dir

FMT = "'%Y-%m-%d %H:%M:%S.%f'"


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


COLLAPSED = f"""{i.CAND}, s AS (SELECT *, concat(titulo, '|', lower(lugar_nombre)) AS serie, CAST(inicio AS date) AS d FROM cand),
g AS (SELECT *, CASE WHEN date_diff('day', lag(d) OVER w, d) > 4 THEN 1 ELSE 0 END AS op FROM s WINDOW w AS (PARTITION BY serie ORDER BY inicio, seq)),
b AS (SELECT *, sum(op) OVER (PARTITION BY serie ORDER BY inicio, seq ROWS UNBOUNDED PRECEDING) AS blk FROM g),
m AS (SELECT serie, blk, count(*) AS n, first(seq ORDER BY inicio, seq) AS seq, first(inicio ORDER BY inicio, seq) AS inicio,
  first(coalesce(fin, inicio) ORDER BY inicio DESC, seq DESC) AS ultimo, first(fin ORDER BY inicio, seq) AS fin0,
  coalesce(first(precio_texto ORDER BY inicio, seq) FILTER (precio_texto <> ''), '') AS precio_texto,
  coalesce(first(imagen_url ORDER BY inicio, seq) FILTER (imagen_url <> ''), '') AS imagen_url,
  first(precio_clp ORDER BY inicio, seq) FILTER (precio_clp IS NOT NULL) AS precio_clp,
  coalesce(first(es_gratis ORDER BY inicio, seq) FILTER (precio_clp IS NOT NULL), first(es_gratis ORDER BY inicio, seq)) AS es_gratis
  FROM b GROUP BY serie, blk)"""


@register("d01_collapse_multiday", f"""WITH {COLLAPSED} SELECT seq, strftime(inicio, {FMT}) AS inicio, strftime(CASE WHEN n > 1 THEN ultimo ELSE fin0 END, {FMT}) AS fin,
  precio_texto, imagen_url, precio_clp, es_gratis FROM m""")
def d01(spark, sf):
    return collapse.collapse_multiday(i.candidates(spark, sf)).select(
        "seq", stamp("inicio").alias("inicio"), stamp("fin").alias("fin"), "precio_texto", "imagen_url", "precio_clp", "es_gratis")


WEEKLY = """rows AS (SELECT event_id AS seq, event_id AS id, concat(event_type, ' Lu 10:00') AS titulo, date_trunc('hour', ts) AS inicio,
  CASE WHEN user_id % 40 = 0 AND event_id % 9 = 0 THEN ts END AS fin, concat('Sala ', cast(user_id AS {text})) AS lugar FROM events)"""


def _weekly(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id AS seq", "event_id AS id", "concat(event_type, ' Lu 10:00') AS titulo",
        "date_trunc('hour', cast(ts as timestamp))::timestamp_ntz AS inicio", "CASE WHEN user_id % 40 = 0 AND event_id % 9 = 0 THEN ts END AS fin",
        "concat('Sala ', cast(user_id AS string)) AS lugar")


@register("d02_collapse_weekly_series", f"""WITH {WEEKLY.replace('{text}', 'varchar')},
g AS (SELECT *, count(*) OVER w AS n, max(inicio) OVER w AS ult, bool_or(fin IS NOT NULL) OVER w AS ended, row_number() OVER (PARTITION BY titulo, lugar, hour(inicio) ORDER BY inicio, seq) AS rn,
  list(isodow(inicio) - 1) OVER w AS dias FROM rows WINDOW w AS (PARTITION BY titulo, lugar, hour(inicio)))
SELECT seq, CASE WHEN ser THEN replace(titulo, ' Lu 10:00', '') ELSE titulo END AS titulo, strftime(inicio, {FMT}) AS inicio,
  strftime(CASE WHEN ser THEN ult ELSE fin END, {FMT}) AS fin, CASE WHEN ser THEN array_to_string(list_sort(list_distinct(dias)), ',') END AS dias,
  CASE WHEN ser THEN CAST(n AS int) END AS sesiones FROM (SELECT *, n >= 3 AND NOT ended AS ser FROM g) WHERE NOT ser OR rn = 1""")
def d02(spark, sf):
    out = collapse.collapse_weekly_series(_weekly(spark, sf))
    return out.select("seq", "titulo", stamp("inicio").alias("inicio"), stamp("fin").alias("fin"),
                      F.array_join("dias_semana", ",").alias("dias"), "sesiones")


@register("d03_degrade_shared_pins", f"""WITH {i.PUB}, p AS (SELECT round_even(lat, 4) AS la, round_even(lon, 4) AS lo FROM pub WHERE precision = 'fuente' GROUP BY 1, 2 HAVING count(DISTINCT lugar) > 1)
SELECT seq, CASE WHEN precision = 'fuente' AND p.la IS NOT NULL THEN 'comuna' ELSE precision END AS precision FROM pub LEFT JOIN p ON round_even(lat, 4) = p.la AND round_even(lon, 4) = p.lo""")
def d03(spark, sf):
    return collapse.degrade_shared_pins(i.published(spark, sf)).select("seq", "precision")


STATE = "CASE min(seq) % 4 WHEN 0 THEN 'borrador' WHEN 1 THEN 'publicado' WHEN 2 THEN 'caducado' ELSE 'descartado' END"
KEYED = f"""{i.CAND}, keyed AS (SELECT *, substr(sha1(concat(titulo, '|', strftime(inicio, '%Y-%m-%d'), '|', lower(lugar_nombre))), 1, 16) AS hash_dedup FROM cand),
stored AS (SELECT hash_dedup, last(titulo ORDER BY seq) AS titulo, last(inicio ORDER BY seq) AS inicio, last(fin ORDER BY seq) AS fin, last(lugar_nombre ORDER BY seq) AS lugar_nombre,
  last(comuna ORDER BY seq) AS comuna, first(fuente_nombre ORDER BY seq) AS fuente_nombre, last(es_gratis ORDER BY seq) AS es_gratis, last(precio_clp ORDER BY seq) AS precio_clp,
  last(fuente_url ORDER BY seq) AS fuente_url, last(lat ORDER BY seq) FILTER (lat IS NOT NULL) AS lat, {STATE} AS estado, min(seq) AS seq0, max(seq) AS seq1 FROM keyed GROUP BY hash_dedup)"""
CURRENT = "CAST(coalesce(fin, inicio) AS date) >= DATE '2024-01-15'"


@register("d04_store_summary", f"""WITH {KEYED} SELECT count(*) AS total, count(*) FILTER (estado = 'borrador') AS borradores, count(*) FILTER (estado = 'publicado') AS publicados,
  count(*) FILTER (es_gratis AND estado <> 'caducado') AS gratis, count(*) FILTER ({CURRENT}) AS vigentes FROM stored""")
def d04(spark, sf):
    return store.store_summary(i.store_rows(spark, sf), i.as_of())


@register("d05_dedup_keep_richest", f"""WITH {i.OFFERS}, k AS (SELECT *, substr(sha1(concat(banco_id, '|', lower(trim(comercio)), '|', lower(comuna))), 1, 12) AS id,
  (len(dias) > 0)::int * 4 + (porcentaje IS NOT NULL)::int * 2 + (oferta <> '')::int + (vigencia_hasta IS NOT NULL)::int AS r FROM offers)
SELECT id, seq, porcentaje, oferta FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY r DESC, seq) = 1""")
def d05(spark, sf):
    return off.dedup_keep_richest(off.with_id(i.offers(spark, sf))).select("id", "seq", "porcentaje", "oferta")


ALIVE = f"(vigencia_hasta IS NULL OR vigencia_hasta >= DATE '{i.OFFER_AS_OF}')"
HERE = "CASE WHEN comuna <> '' THEN comuna <> 'Talca' ELSE region IN ('', 'Metropolitana') END"


@register("d06_offers_bank_stats", f"""WITH {i.OFFERS} SELECT banco, count(*) AS crudos, count(*) FILTER ({ALIVE} AND {HERE}) AS vigentes, count(*) FILTER ({ALIVE} AND {HERE} AND len(dias) > 0) AS con_dia,
  count(*) FILTER (NOT {ALIVE}) AS vencidos, count(*) FILTER ({ALIVE} AND NOT {HERE}) AS fuera_rm FROM offers GROUP BY banco""")
def d06(spark, sf):
    return off.bank_stats(i.offers(spark, sf), F.lit(i.OFFER_AS_OF))


@register("d07_day_histogram", f"WITH {i.OFFERS} SELECT dia, count(*) AS n FROM (SELECT unnest(dias) AS dia FROM offers) GROUP BY dia")
def d07(spark, sf):
    return off.day_histogram(i.offers(spark, sf))


@register("d08_facet_values", f"WITH {i.OFFERS} SELECT DISTINCT 'banco' AS facet, banco AS value FROM offers UNION ALL SELECT DISTINCT 'comuna', comuna FROM offers WHERE comuna <> ''")
def d08(spark, sf):
    return off.facet_values(i.offers(spark, sf))


@register("d09_top_areas", f"WITH {i.OFFERS} SELECT comuna, count(*) AS n FROM offers WHERE comuna <> '' GROUP BY comuna ORDER BY n DESC, comuna LIMIT 3")
def d09(spark, sf):
    return off.top_areas(i.offers(spark, sf), 3)


@register("d10_place_queue", f"""WITH {i.PUB} SELECT lugar, comuna, count(*) AS eventos, coalesce(first(direccion ORDER BY seq) FILTER (direccion <> ''), '') AS direccion
  FROM pub WHERE precision IN ('comuna', 'sin_ubicar') GROUP BY lugar, comuna""")
def d10(spark, sf):
    return review.place_queue(i.published(spark, sf))


@register("d11_merchant_queues", f"""WITH {i.OFFERS} SELECT comercio, 'sin_pin' AS cola, count(*) AS n, array_to_string(list_sort(list(DISTINCT banco)), ',') AS bancos FROM offers WHERE precision <> 'fuente' GROUP BY comercio
  UNION ALL SELECT comercio, 'sin_cocina', count(*), NULL FROM offers GROUP BY comercio""")
def d11(spark, sf):
    return review.merchant_queues(i.offers(spark, sf)).withColumn("bancos", F.array_join("bancos", ","))


@register("d12_uncategorised_queue", f"WITH {i.PUB} SELECT seq, strftime(inicio, {FMT}) AS inicio FROM pub WHERE categoria = 'otros' ORDER BY pub.inicio, seq")
def d12(spark, sf):
    return review.uncategorised_queue(i.published(spark, sf)).select("seq", stamp("inicio").alias("inicio"))


@register("d13_undated_queue", f"""WITH {i.CAND}, u AS (SELECT substr(sha1(concat(titulo, '||', lower(lugar_nombre))), 1, 16) AS hash_dedup, titulo, fuente_url, seq FROM cand WHERE seq % 3 = 0)
  SELECT hash_dedup, last(titulo ORDER BY seq) AS titulo, last(fuente_url ORDER BY seq) AS fuente_url FROM u GROUP BY hash_dedup""")
def d13(spark, sf):
    c = i.candidates(spark, sf).withColumn("inicio", F.when(F.col("seq") % 3 != 0, F.col("inicio")))
    from kermesse.schemas import STORE
    fresh = store.upsert_events(spark.createDataFrame([], STORE), c, i.now())
    return review.undated_queue(fresh).select("hash_dedup", "titulo", "fuente_url")


@register("d14_precision_breakdown", f"WITH {i.PUB} SELECT precision, count(*) AS n, CAST(count(*) * 100 // (SELECT count(*) FROM pub) AS int) AS pct FROM pub GROUP BY precision")
def d14(spark, sf):
    return review.precision_breakdown(i.published(spark, sf))


@register("d16_first_seen_places", f"""WITH {i.CAND} SELECT concat(lugar_nombre, ' ', titulo) AS lugar, count(DISTINCT CAST(inicio AS date)) AS n FROM cand GROUP BY 1 HAVING min(CAST(inicio AS date)) = DATE '2024-01-09'""")
def d16(spark, sf):
    rows = i.store_rows(spark, sf).withColumns({"fecha_extraccion": F.col("inicio"), "lugar_nombre": F.concat_ws(" ", "lugar_nombre", "titulo")})
    return review.first_seen_places(rows, F.lit("2024-01-09")).select(F.col("lugar_nombre").alias("lugar"), "n")


# Run log: one row per day and type, the error type fails on Mondays and Tuesdays.
RUNS = """runs AS (SELECT event_type AS fuente, max(ts) AS momento, CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS encontrados, count(*) AS nuevos, 0 AS actualizados, 0 AS descartados,
  CASE WHEN event_type = 'error' AND isodow(CAST(ts AS date)) <= 2 THEN concat('fallo ', CAST(ts AS date)) ELSE '' END AS error, sum(value) AS duracion_seg FROM events GROUP BY event_type, CAST(ts AS date))"""


def _runs(spark, sf):
    day = F.col("ts").cast("date")
    g = table(spark, sf, "events").groupBy(F.col("event_type").alias("fuente"), day.alias("d")).agg(
        F.max("ts").alias("momento"), F.count(F.lit(1)).alias("nuevos"), F.sum("value").alias("duracion_seg"))
    bad = F.col("fuente") == "error"
    return g.select("fuente", "momento", F.when(bad, 0).otherwise(F.col("nuevos")).cast("int").alias("encontrados"), F.col("nuevos").cast("int").alias("nuevos"),
                    F.lit(0).alias("actualizados"), F.lit(0).alias("descartados"),
                    F.when(bad & (F.weekday("d") <= 1), F.concat(F.lit("fallo "), F.col("d").cast("string"))).otherwise("").alias("error"), "duracion_seg")


@register("d17_run_diagnostics", f"""WITH {RUNS}, {i.PUB}, l AS (SELECT * FROM runs WHERE CAST(momento AS date) = DATE '2024-01-16')
SELECT count(*) AS fuentes_total, count(*) FILTER (error <> '') AS fuentes_error, count(*) FILTER (error = '' AND encontrados = 0) AS fuentes_en_cero, CAST(sum(encontrados) AS bigint) AS encontrados,
  (SELECT count(*) FROM pub) AS total, (SELECT count(*) FROM pub WHERE precision IN ('recinto', 'fuente')) AS exactos, (SELECT count(*) FROM pub WHERE precision = 'sin_ubicar') AS sin_pin,
  (SELECT count(*) FROM pub WHERE seq % 7 = 0) AS altas, (SELECT count(*) FROM pub WHERE seq % 7 <> 0 AND seq % 5 = 0) * 0 AS bajas FROM l""")
def d17(spark, sf):
    pub = i.published(spark, sf)
    latest = review.latest_run_per_source(_runs(spark, sf), F.lit("2024-01-16"))
    stale = review.stale_sources(latest, i.store_rows(spark, sf), i.as_of())
    out = review.run_diagnostics(latest, stale, pub, pub.filter("seq % 7 <> 0").select("id"))
    return out.select("fuentes_total", "fuentes_error", "fuentes_en_cero", "encontrados", "total", "exactos", "sin_pin", "altas", "bajas")


@register("d18_run_trend", f"WITH {RUNS} SELECT fuente, strftime(momento, {FMT}) AS momento, encontrados FROM runs ORDER BY runs.momento DESC LIMIT 40")
def d18(spark, sf):
    runs = _runs(spark, sf)
    old, new = runs.filter("momento < '2024-01-20'"), runs.filter("momento >= '2024-01-20'")
    return store.run_trend(old, new, 40).select("fuente", stamp("momento").alias("momento"), "encontrados")


@register("d19_review_queue", f"""WITH {i.PUB} SELECT seq, CASE WHEN precision = 'sin_ubicar' THEN '1. sin pin' WHEN categoria = 'otros' THEN '2. sin categoria' WHEN fuente = 'click' THEN '3. categoria adivinada'
  WHEN precision = 'comuna' THEN '4. pin aproximado' END AS motivo FROM pub WHERE precision IN ('sin_ubicar', 'comuna') OR categoria = 'otros' OR fuente = 'click'""")
def d19(spark, sf):
    pub = i.published(spark, sf).withColumn("origen", F.when(F.col("fuente") == "click", "prior").otherwise("titulo"))
    return review.review_queue(pub).select("seq", "motivo")


@register("d20_stale_sources", f"""WITH {RUNS} SELECT fuente FROM runs WHERE CAST(momento AS date) = DATE '2024-01-16' AND error = '' AND encontrados > 0
  AND fuente NOT IN (SELECT event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND user_id % 30 = 7 AND event_id % 3 = 0 AND event_type <> 'click')""")
def d20(spark, sf):
    latest = review.latest_run_per_source(_runs(spark, sf), F.lit("2024-01-16"))
    few = i.candidates(spark, sf).filter("seq % 3 = 0 AND descripcion_corta rlike ' (7|37|67|97|127)$' AND fuente_nombre <> 'click'").withColumn("fin", F.lit(None).cast("timestamp_ntz"))
    return review.stale_sources(latest, few, i.as_of())


FILTERS = {"cuando": "inicio >= TIMESTAMP '2024-01-15'", "precio": "gratis OR coalesce(precio <= 100000, false)", "categoria": "categoria IN ('musica', 'feria')", "publico": "publico IN ('ninos', 'todos')"}


def _filters():
    return {k: F.expr(v.replace("TIMESTAMP '", "timestamp_ntz'")) for k, v in FILTERS.items()}


def _others(name: str) -> str:
    return " AND ".join(f"({v})" for k, v in FILTERS.items() if k != name)


@register("d21_facet_counts", f"""WITH {i.PUB} SELECT 'categoria' AS faceta, categoria AS opcion, count(*) AS n FROM pub WHERE {_others('categoria')} GROUP BY categoria
  UNION ALL SELECT 'publico', publico, count(*) FROM pub WHERE {_others('publico')} GROUP BY publico""")
def d21(spark, sf):
    return discover.facet_counts(i.published(spark, sf), _filters(), {"categoria": F.array("categoria"), "publico": F.array("publico")})


@register("d22_blocking_filter", f"WITH {i.PUB} " + " UNION ALL ".join(f"SELECT '{k}' AS filtro, count(*) AS n FROM pub WHERE {_others(k)}" for k in FILTERS))
def d22(spark, sf):
    return discover.blocking_filter(i.published(spark, sf), _filters())


@register("d23_cluster_approx_pins", f"""WITH {i.PUB}, p AS (SELECT *, CASE WHEN seq % 6 = 5 THEN 'comuna' ELSE precision END AS pr FROM pub WHERE lat IS NOT NULL)
  SELECT id, comuna, round(lat, 6) AS lat, 1 AS eventos FROM p WHERE pr <> 'comuna'
  UNION ALL SELECT NULL, min(comuna), round(first(lat ORDER BY seq), 6), count(*) FROM p WHERE pr = 'comuna' GROUP BY CASE WHEN comuna <> '' THEN comuna ELSE concat(lat, ',', lon) END""")
def d23(spark, sf):
    pub = i.published(spark, sf).withColumn("precision", F.when(F.col("seq") % 6 == 5, "comuna").otherwise(F.col("precision")))
    return discover.cluster_approx_pins(pub).select("id", "comuna", F.round("lat", 6).alias("lat"), "eventos")


@register("d24_mark_recurrent", f"WITH {i.PUB} SELECT seq, count(*) OVER (PARTITION BY titulo, lugar) > 3 AS recurrente FROM pub")
def d24(spark, sf):
    pub = i.published(spark, sf).withColumn("titulo", F.concat("titulo", F.lit(" "), "lugar", F.lit(" 19:30 h.")))
    return collapse.mark_recurrent(pub).select("seq", "recurrente")


@register("d25_source_run_counts", f"""WITH {i.CAND} SELECT fuente_nombre, count(*) AS encontrados, count(*) FILTER (seq % 3 = 0) AS nuevos, count(*) FILTER (seq % 3 = 1) AS actualizados, count(*) FILTER (seq % 3 = 2) AS descartados
  FROM cand GROUP BY fuente_nombre""")
def d25(spark, sf):
    rows = i.candidates(spark, sf).selectExpr("fuente_nombre", "CASE seq % 3 WHEN 0 THEN 'nuevo' WHEN 1 THEN 'actualizado' END AS resultado",
                                              "CASE WHEN seq % 3 = 2 THEN 'x' END AS motivo")
    return review.source_run_counts(rows)


@register("e01_gap_islands", f"""WITH {COLLAPSED} SELECT serie, CAST(blk AS int) AS bloque, count(DISTINCT d) AS dias FROM b GROUP BY serie, blk""")
def e01(spark, sf):
    days = i.candidates(spark, sf).select(F.concat_ws("|", "titulo", F.lower("lugar_nombre")).alias("serie"), F.col("inicio").cast("date").alias("d")).distinct()
    return collapse.gap_islands(days, ["serie"], "d", 4).groupBy("serie", F.col("bloque").cast("int").alias("bloque")).agg(F.count(F.lit(1)).alias("dias"))


@register("e02_latest_run_per_source", """SELECT event_type AS fuente, max(event_id) AS event_id FROM events WHERE CAST(ts AS date) = DATE '2024-01-16' GROUP BY event_type""")
def e02(spark, sf):
    runs = table(spark, sf, "events").select(F.col("event_type").alias("fuente"), F.col("ts").alias("momento"), "event_id")
    log = review.append_run_log(runs, f"{ensure_checkpoint_dir(spark)}/log-{uuid.uuid4().hex}")
    return review.latest_run_per_source(log, F.lit("2024-01-16")).select("fuente", "event_id")


@register("e03_degraded_sources", """WITH r AS (SELECT concat(event_type, user_id) AS fuente, ts AS momento, CASE WHEN user_id % 3 = 0 THEN 0 ELSE event_id % 2 END AS encontrados,
  CASE WHEN event_id % 5 = 0 THEN concat('e', event_id) ELSE '' END AS error FROM events),
t AS (SELECT *, row_number() OVER (PARTITION BY fuente ORDER BY momento DESC) AS rn FROM r QUALIFY rn <= 3)
SELECT fuente, coalesce(first(error ORDER BY rn) FILTER (error <> ''), '') AS ultimo_error, strftime(min(momento), '%Y-%m-%d') AS desde FROM t GROUP BY fuente
HAVING count(*) >= 3 AND bool_and(error <> '' OR encontrados = 0)""")
def e03(spark, sf):
    runs = table(spark, sf, "events").selectExpr("concat(event_type, user_id) AS fuente", "ts AS momento", "CASE WHEN user_id % 3 = 0 THEN 0 ELSE event_id % 2 END AS encontrados",
                                                 "CASE WHEN event_id % 5 = 0 THEN concat('e', event_id) ELSE '' END AS error")
    return review.degraded_sources(runs)


@register("e04_top_k_per_source", "SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 40")
def e04(spark, sf):
    return skew.top_k(table(spark, sf, "events"), ["event_type"], [F.desc("value"), F.col("event_id")], 40).select("event_type", "event_id")


@register("e04_top_k_per_row_budget", "SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= length(event_type) * 7")
def e04b(spark, sf):
    return skew.top_k(table(spark, sf, "events"), ["event_type"], [F.desc("value"), F.col("event_id")], F.length("event_type") * 7).select("event_type", "event_id")


@register("e05_failure_streaks", """WITH f AS (SELECT event_type AS host, ts, event_id, user_id % 3 = 0 AS ok FROM events),
g AS (SELECT *, sum(ok::int) OVER (PARTITION BY host ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM f)
SELECT host, max(n) AS racha FROM (SELECT host, grp, count(*) FILTER (NOT ok) AS n FROM g GROUP BY host, grp) GROUP BY host HAVING max(n) >= 3""")
def e05(spark, sf):
    f = table(spark, sf, "events").selectExpr("event_type AS host", "ts", "event_id AS seq", "user_id % 3 = 0 AS ok")
    return review.failure_streaks(f)


@register("e06_first_nonnull_fill", f"WITH {i.CAND} SELECT titulo, first(precio_texto ORDER BY inicio, seq) FILTER (precio_texto <> '') AS precio_texto FROM cand GROUP BY titulo")
def e06(spark, sf):
    return collapse.first_filled(i.candidates(spark, sf), ["titulo"], [F.col("inicio"), F.col("seq")], "precio_texto")


@register("f01_agenda_order", f"WITH {i.PUB} SELECT seq, titulo FROM pub ORDER BY inicio NULLS LAST, seq")
def f01(spark, sf):
    return store.agenda_order(i.published(spark, sf)).select("seq", "titulo")


@register("f02_offer_value_order", f"WITH {i.OFFERS} SELECT seq, coalesce(porcentaje, 0) AS pct FROM offers ORDER BY pct DESC, lower(comercio), banco, seq")
def f02(spark, sf):
    rows = i.offers(spark, sf).withColumn("id", F.col("seq"))
    return off.offer_value_order(rows).select("seq", F.coalesce("porcentaje", F.lit(0)).alias("pct"))


@register("f03_impact_order", f"WITH {i.PUB} SELECT lugar, comuna, count(*) AS eventos FROM pub WHERE precision IN ('comuna', 'sin_ubicar') GROUP BY lugar, comuna ORDER BY eventos DESC, lugar, comuna")
def f03(spark, sf):
    return review.impact_order(review.place_queue(i.published(spark, sf)), "eventos", "lugar", "comuna").select("lugar", "comuna", "eventos")


@register("f05_snapshot_order", f"WITH {KEYED} SELECT hash_dedup, titulo, fuente_url FROM stored ORDER BY hash_dedup")
def f05(spark, sf):
    lines = store.snapshot_lines(i.store_rows(spark, sf)).orderBy("hash_dedup")
    return lines.select("hash_dedup", F.get_json_object("line", "$.titulo").alias("titulo"), F.get_json_object("line", "$.fuente_url").alias("fuente_url"))


@register("g01_union_sources", f"WITH {i.CAND} SELECT seq, CASE WHEN fuente_nombre = 'view' THEN NULL ELSE precio_clp END AS precio_clp FROM cand")
def g01(spark, sf):
    c = i.candidates(spark, sf).select("seq", "fuente_nombre", "precio_clp")
    parts = [c.filter(F.col("fuente_nombre") == n) for n in ("click", "error", "purchase", "signup")]
    return store.union_sources(*parts, c.filter("fuente_nombre = 'view'").select("seq")).select("seq", "precio_clp")


@register("g02_split_formats", f"""WITH {i.PUB} SELECT seq, CASE WHEN categoria = 'clases' OR seq % 6 = 0 THEN 'taller' ELSE 'panorama' END AS formato,
  CASE WHEN seq % 6 = 0 THEN '1' WHEN categoria = 'clases' THEN '0,2' END AS dias, strftime(CASE WHEN seq % 22 = 0 THEN NULL ELSE fin END, {FMT}) AS fin FROM pub""")
def g02(spark, sf):
    pub = i.published(spark, sf).withColumns({
        "titulo": F.concat("titulo", F.lit(" Lu-Mi 10:00")), "dias_semana": F.when(F.col("seq") % 6 == 0, F.array(F.lit(1))),
        "fin": F.when(F.col("seq") % 22 == 0, F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("fin"))})
    return store.split_formats(pub).select("seq", "formato", F.array_join("dias_semana", ",").alias("dias"), stamp("fin").alias("fin"))


@register("g03_union_published", f"WITH {i.PUB} SELECT id, categoria FROM pub")
def g03(spark, sf):
    pub = i.published(spark, sf)
    return store.union_sources(pub.filter("categoria = 'clases'"), pub.filter("categoria <> 'clases'")).select("id", "categoria")


@register("g04_catalog_delta", "SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'baja' ELSE 'alta' END AS cambio FROM events WHERE event_id % 3 = 0 AND event_id % 4 <> 0 OR event_id % 3 <> 0 AND event_id % 4 = 0")
def g04(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"))
    return store.catalogue_delta(e.filter("id % 3 = 0"), e.filter("id % 4 = 0"))


@register("g05_distinct_ids", "SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1")
def g05(spark, sf):
    return store.duplicate_ids(table(spark, sf, "events").select(F.col("user_id").alias("id")))


# Upsert: the store holds what started before the 16th, the batch is everything from the 10th on.
SPLIT = KEYED.replace("FROM keyed GROUP BY hash_dedup)", "FROM keyed WHERE inicio < TIMESTAMP '2024-01-16' GROUP BY hash_dedup)") + """,
batch AS (SELECT hash_dedup, last(fuente_url ORDER BY seq) AS fuente_url, last(precio_clp ORDER BY seq) AS precio_clp, last(lat ORDER BY seq) FILTER (lat IS NOT NULL) AS lat, first(fuente_nombre ORDER BY seq) AS fuente_nombre
  FROM keyed WHERE inicio >= TIMESTAMP '2024-01-10' GROUP BY hash_dedup)"""


@register("k01_upsert_events", f"""WITH {SPLIT} SELECT hash_dedup, CASE WHEN b.hash_dedup IS NULL THEN s.fuente_url ELSE b.fuente_url END AS fuente_url, CASE WHEN b.hash_dedup IS NULL THEN s.precio_clp ELSE b.precio_clp END AS precio_clp,
  coalesce(b.lat, s.lat) AS lat, coalesce(s.estado, 'borrador') AS estado, CASE WHEN b.hash_dedup IS NULL THEN NULL WHEN s.hash_dedup IS NULL THEN 'nuevo' ELSE 'actualizado' END AS resultado,
  coalesce(s.fuente_nombre, b.fuente_nombre) AS fuente_nombre FROM stored s FULL JOIN batch b USING (hash_dedup)""")
def k01(spark, sf):
    old = i.store_rows(spark, sf, until="2024-01-16 00:00:00")
    batch = i.candidates(spark, sf).filter("inicio >= timestamp_ntz'2024-01-10 00:00:00'")
    return store.upsert_events(old, batch, i.now()).select("hash_dedup", "fuente_url", "precio_clp", "lat", "estado", "resultado", "fuente_nombre")


@register("k02_expire_past", f"WITH {KEYED} SELECT hash_dedup, CASE WHEN {CURRENT} THEN estado ELSE 'caducado' END AS estado, CASE WHEN NOT {CURRENT} AND estado <> 'caducado' THEN estado END AS estado_previo FROM stored")
def k02(spark, sf):
    return store.expire_past(i.store_rows(spark, sf), i.as_of()).select("hash_dedup", "estado", "estado_previo")


@register("k03_revive_current", f"WITH {KEYED} SELECT hash_dedup, CASE WHEN {CURRENT} AND estado = 'caducado' THEN 'borrador' ELSE estado END AS estado FROM stored")
def k03(spark, sf):
    return store.revive_current(i.store_rows(spark, sf), i.as_of()).select("hash_dedup", "estado")


@register("k03_state_survives_runs", f"""WITH {KEYED} SELECT hash_dedup, CASE WHEN NOT {CURRENT} THEN 'caducado' WHEN estado = 'caducado' THEN 'borrador' ELSE estado END AS estado,
  CAST(NULL AS varchar) AS estado_previo FROM stored WHERE {CURRENT}""")
def k03b(spark, sf):
    """Everything expires, the sources bring it again, and what runs is revived with the state it had."""
    ended = store.expire_past(i.store_rows(spark, sf), F.lit("2030-01-01").cast("date"))
    seen = store.upsert_events(ended, i.candidates(spark, sf), i.now()).drop("resultado")
    kept = store.parse_lines(store.snapshot_lines(seen).select("line"))
    return store.revive_current(kept, i.as_of()).filter("estado <> 'caducado'").select("hash_dedup", "estado", "estado_previo")


@register("k04_pending_review", f"WITH {KEYED} SELECT hash_dedup FROM stored WHERE estado = 'borrador' AND {CURRENT}")
def k04(spark, sf):
    return store.pending_review(i.store_rows(spark, sf), i.as_of()).select("hash_dedup")


@register("k04_new_today", f"WITH {KEYED} SELECT hash_dedup FROM stored WHERE estado = 'borrador'")
def k04b(spark, sf):
    return store.new_today(i.store_rows(spark, sf), F.lit("2024-01-10")).select("hash_dedup")


@register("k05_snapshot_write", f"WITH {KEYED} SELECT hash_dedup, estado, coalesce(precio_clp, -1) AS precio FROM stored")
def k05(spark, sf):
    path = f"{ensure_checkpoint_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    store.write_snapshot(i.store_rows(spark, sf), path)
    lines = spark.read.text(f"{path}/rows").withColumnRenamed("value", "line")
    return lines.select(F.get_json_object("line", "$.hash_dedup").alias("hash_dedup"), F.get_json_object("line", "$.estado").alias("estado"),
                        F.coalesce(F.get_json_object("line", "$.precio_clp").cast("int"), F.lit(-1)).alias("precio"))


@register("k06_snapshot_restore", f"WITH {KEYED} SELECT hash_dedup, titulo, strftime(inicio, {FMT}) AS inicio, lat FROM stored")
def k06(spark, sf):
    path = f"{ensure_checkpoint_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    rows = i.store_rows(spark, sf)
    store.write_snapshot(rows, path)
    back = store.restore_snapshot(spark, path, rows.filter("hash_dedup < '8'"))
    return back.select("hash_dedup", "titulo", stamp("inicio").alias("inicio"), "lat")


def _published_catalogue(spark, sf):
    """Two versions are written; the newer one is read."""
    path = f"{ensure_checkpoint_dir(spark)}/catalogue-{uuid.uuid4().hex}"
    rows = i.published(spark, sf)
    shaped = rows.withColumn("formato", F.when(F.col("categoria") == "clases", "taller").otherwise("panorama"))
    store.publish_catalogue(shaped.filter("seq % 2 = 0"), i.now() - F.expr("interval 1 day"), path)
    store.publish_catalogue(shaped, i.now(), path)
    return store.read_published(spark, path)


@register("k07_publish_catalog", f"""WITH {i.PUB} SELECT '2024-01-15' AS generado, (SELECT count(*) FROM pub) AS total, CASE WHEN categoria = 'clases' THEN 'taller' ELSE 'panorama' END AS formato, fuente, count(*) AS n FROM pub GROUP BY ALL""")
def k07(spark, sf):
    """The published rows as written and read back, counted by format and source, beside their header."""
    header, rows, _ = _published_catalogue(spark, sf)
    head = header.first()
    return rows.groupBy("formato", "fuente").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"{head.generado:%Y-%m-%d}").alias("generado"), F.lit(head.total).alias("total"), "formato", "fuente", "n")


@register("k07_catalogue_facets", f"""WITH {i.PUB} SELECT faceta, valor, count(*) AS n FROM (SELECT 'categoria' AS faceta, categoria AS valor FROM pub UNION ALL SELECT 'comuna', comuna FROM pub UNION ALL SELECT 'publico', publico FROM pub)
  WHERE valor <> '' GROUP BY ALL""")
def k07b(spark, sf):
    return _published_catalogue(spark, sf)[2]


@register("k08_bank_run_state", f"""WITH {i.OFFERS}, st AS (SELECT banco, count(*) AS crudos FROM offers WHERE banco <> 'Brand#3' GROUP BY banco)
  SELECT banco, st.crudos IS NOT NULL AS corrio, coalesce(crudos, 0) AS crudos, CASE WHEN crudos IS NULL THEN 'adaptador desconocido: x' ELSE '' END AS error FROM (SELECT DISTINCT p_brand AS banco FROM part) LEFT JOIN st USING (banco)""")
def k08(spark, sf):
    banks = table(spark, sf, "part").select(F.col("p_brand").alias("banco"), F.lit("x").alias("adaptador")).distinct()
    stats = off.bank_stats(i.offers(spark, sf).filter("banco <> 'Brand#3'"), F.lit(i.OFFER_AS_OF))
    return off.bank_run_state(banks, stats).select("banco", "corrio", "crudos", "error")


@register("k09_capture_age_alert", f"""WITH {i.OFFERS}, f AS (SELECT banco, first(coalesce(vigencia_hasta, DATE '1998-06-01') ORDER BY seq) AS capturado FROM offers GROUP BY banco)
  SELECT banco, CAST(date_diff('day', capturado, DATE '1998-06-15') AS int) AS dias FROM f WHERE date_diff('day', capturado, DATE '1998-06-15') > 20""")
def k09(spark, sf):
    rows = i.offers(spark, sf).withColumn("capturado", F.coalesce("vigencia_hasta", F.lit("1998-06-01").cast("date")).cast("string"))
    banks = rows.select("banco", F.lit(20).alias("avisar_dias")).distinct()
    return off.capture_age_alert(rows, banks, F.lit("1998-06-15")).select("banco", "dias")
