"""Profiles against published rows, and the quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from kermesse.bindings import inputs as i
from kermesse.bindings.registry import register, table
from kermesse.operators import quality, recommend
from kermesse.operators.recommend import Profile

PROFILES = [
    Profile("gratis", "solo", "panorama", "seguro", free_only=True),
    Profile("carrete", "amigos", "musica", "fuerte"),
    Profile("barrio", "ninos", "barrio", "pasear"),
    Profile("fijo", "solo", "mover", "taller", budget=300000),
]
ROWS = i.PUB + """, r AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN concat(fuente, ' taller') ELSE concat(fuente, ' ', seq) END AS titulo), seq % 3 = 0 AS recurrente, publico = 'ninos' AS ninos, publico = 'adultos' AS adulto FROM pub)"""


def _prepared(spark, sf):
    pub = i.published(spark, sf).withColumn("titulo", F.when(F.col("seq") % 3 == 0, F.concat("fuente", F.lit(" taller"))).otherwise(
        F.concat_ws(" ", "fuente", F.col("seq").cast("string"))))
    return recommend.prepare(pub)


ELIGIBLE = {
    "gratis": "gratis AND NOT recurrente", "carrete": "categoria = 'musica' AND NOT recurrente AND NOT (ninos AND NOT adulto)",
    "barrio": "ninos AND categoria IN ('feria', 'musica') AND NOT recurrente", "fijo": "categoria = 'deporte' AND (gratis OR coalesce(precio <= 300000, true))",
}


@register("j01_eligible_pairs", f"WITH {ROWS} " + " UNION ALL ".join(f"SELECT '{k}' AS perfil, seq FROM r WHERE {v}" for k, v in ELIGIBLE.items()))
def j01(spark, sf):
    return recommend.eligible_pairs(_prepared(spark, sf), recommend.profiles_of(spark, PROFILES)).select("perfil", "seq")


HAS_HOUR = "NOT (hour(inicio) = 0 AND minute(inicio) = 0)"


def _band(lo: int, hi: int) -> str:
    inside = f"hour(inicio) BETWEEN {lo} AND {hi}" if lo <= hi else f"(hour(inicio) >= {lo} OR hour(inicio) <= {hi})"
    return f"CASE WHEN {HAS_HOUR} THEN CASE WHEN {inside} THEN 3 ELSE -2 END ELSE 0 END"


COMMON = """CASE WHEN imagen <> '' THEN 2 ELSE 0 END + CASE precision WHEN 'sin_ubicar' THEN -2 WHEN 'recinto' THEN 1 ELSE 0 END
  + greatest(0, 3 - (epoch_us(inicio) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) / 86400e6 * 0.12)"""
SCORE = {
    "gratis": "CASE categoria WHEN 'clases' THEN 9 WHEN 'feria' THEN 9 WHEN 'musica' THEN 10 ELSE 6 END + 4",
    "carrete": f"23 + CASE WHEN gratis THEN 1 ELSE 0 END + {_band(19, 3)} + CASE WHEN ninos THEN -3 ELSE 0 END",
    "barrio": f"CASE categoria WHEN 'feria' THEN 16 ELSE 2 END + CASE WHEN gratis THEN 4 ELSE 0 END + CASE WHEN precio > 15000 THEN -6 ELSE 0 END + {_band(9, 19)}",
    "fijo": f"17 + CASE WHEN recurrente THEN 6 ELSE 0 END + CASE WHEN gratis THEN 3 ELSE 0 END + {_band(7, 21)}",
}


@register("j02_score_pairs", f"WITH {ROWS}, s AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS perfil, seq, {SCORE[k]} + {COMMON} AS puntaje FROM r WHERE {ELIGIBLE[k]}" for k in ELIGIBLE) + ") SELECT perfil, seq, round(puntaje, 4) AS puntaje FROM s WHERE puntaje > 0")
def j02(spark, sf):
    return recommend.score_pairs(_prepared(spark, sf), recommend.profiles_of(spark, PROFILES), i.now()).select("perfil", "seq", F.round("puntaje", 4).alias("puntaje"))


# The greedy pass in rounds: what leads under all its keys is kept, what meets a kept row is dropped, the rest waits.
GREEDY = f"""WITH RECURSIVE {ROWS}, s AS (""" + " UNION ALL ".join(
    f"SELECT '{k}' AS perfil, seq, lugar, titulo, categoria, gratis, recurrente, ninos, {SCORE[k]} + {COMMON} AS puntaje FROM r WHERE {ELIGIBLE[k]}" for k in ELIGIBLE) + """),
scored AS (SELECT *, row_number() OVER (PARTITION BY perfil ORDER BY puntaje DESC, seq) AS rk FROM s WHERE puntaje > 0),
keyed AS (SELECT perfil, seq, rk, unnest(['s:' || lugar, 't:' || titulo, CASE WHEN perfil = 'gratis' THEN 'c:' || categoria ELSE 's:' || lugar END]) AS key FROM scored),
it AS (SELECT DISTINCT perfil, seq, rk, key, 'open' AS st FROM keyed
  UNION ALL SELECT perfil, seq, rk, key, CASE WHEN kept THEN 'kept' ELSE 'open' END FROM (SELECT *, bool_or(beaten) OVER (PARTITION BY perfil, seq) AS gone
    FROM (SELECT *, bool_or(kept) OVER (PARTITION BY perfil, key) AS beaten FROM (SELECT *, bool_and(rk = first) OVER (PARTITION BY perfil, seq) AS kept
      FROM (SELECT *, min(rk) OVER (PARTITION BY perfil, key) AS first FROM it WHERE st = 'open')))) WHERE kept OR NOT gone),
ranked AS (SELECT scored.*, (perfil, seq) IN (SELECT (perfil, seq) FROM it WHERE st = 'kept') AS elegido FROM scored)"""


@register("j03_rank_diverse", f"{GREEDY} SELECT perfil, seq, elegido, round(puntaje, 4) AS puntaje FROM ranked")
def j03(spark, sf):
    scored = recommend.score_pairs(_prepared(spark, sf), recommend.profiles_of(spark, PROFILES), i.now()).withColumn("fuente", F.col("lugar"))
    return recommend.rank_diverse(scored).select("perfil", "seq", "elegido", F.round("puntaje", 4).alias("puntaje"))


@register("j04_profile_regression_report", f"""{GREEDY}, top AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY perfil ORDER BY elegido DESC, puntaje DESC, seq) <= 5),
n AS (SELECT perfil, count(*) AS vistos, sum(CASE perfil WHEN 'gratis' THEN (NOT gratis)::int + recurrente::int WHEN 'carrete' THEN ninos::int WHEN 'barrio' THEN (NOT ninos)::int ELSE (categoria <> 'deporte')::int END) AS alarmas FROM top GROUP BY perfil)
SELECT perfil, coalesce(vistos, 0) AS vistos, coalesce(alarmas, 0)::bigint AS alarmas, vistos IS NULL AS vacio FROM (SELECT unnest({list(ELIGIBLE)}) AS perfil) LEFT JOIN n USING (perfil)""")
def j04(spark, sf):
    scored = recommend.score_pairs(_prepared(spark, sf), recommend.profiles_of(spark, PROFILES), i.now()).withColumn("fuente", F.col("lugar"))
    bad = {"gratis": {"pidio gratis": ~F.col("gratis"), "es un taller": F.col("recurrente")}, "carrete": {"es infantil": F.col("para_ninos")},
           "barrio": {"no es para ninos": ~F.col("para_ninos")}, "fijo": {"no es deporte": F.col("categoria") != "deporte"}}
    return recommend.profile_report(recommend.rank_diverse(scored), PROFILES, bad)


@register("j05_situations_for_company", """SELECT DISTINCT compania, situacion FROM (SELECT ['solo', 'pareja', 'amigos', 'ninos'][event_id % 4 + 1] AS compania, ['noche', 'mover', 'barrio'][user_id % 3 + 1] AS situacion FROM events)
  WHERE NOT (compania = 'ninos' AND situacion = 'noche')""")
def j05(spark, sf):
    from kermesse.bindings.scalars import pick
    pairs = table(spark, sf, "events").select(pick(["solo", "pareja", "amigos", "ninos"], F.col("event_id") % 4).alias("compania"),
                                              pick(["noche", "mover", "barrio"], F.col("user_id") % 3).alias("situacion"))
    return recommend.allowed_pairs(pairs.distinct())


def _broken(spark, sf):
    """Published rows with defects planted by order number."""
    s = F.col("seq")
    return i.published(spark, sf).withColumns({
        "id": F.when(s % 500 == 3, s - 1).otherwise(s), "titulo": F.when(s % 101 == 0, "").otherwise(F.col("titulo")),
        "lat": F.when(s % 103 == 0, F.lit(-30.0)).otherwise(F.col("lat")), "lon": F.when(s % 103 == 0, F.lit(-70.6)).when(s % 107 == 0, F.lit(None)).otherwise(F.col("lon")),
        "categoria": F.when(s % 109 == 0, "rara").otherwise(F.col("categoria")), "escala": F.when(s % 113 == 0, "enorme").otherwise(""),
        "fin": F.when(s % 127 == 0, F.col("inicio") - F.expr("interval 1 day")).otherwise(F.col("fin"))})


BROKEN = i.PUB + """, z AS (SELECT seq, CASE WHEN seq % 500 = 3 THEN seq - 1 ELSE seq END AS id, seq % 101 = 0 AS no_title, CASE WHEN seq % 103 = 0 THEN -30e0 ELSE lat END AS la,
  CASE WHEN seq % 103 = 0 THEN -70.6e0 WHEN seq % 107 = 0 THEN NULL ELSE lon END AS lo, url, fin IS NOT NULL AS has_fin FROM pub)"""


@register("l01_check_events", f"""WITH {BROKEN}, p AS (SELECT id, 'error' AS level, 'sin titulo' AS detail FROM z WHERE no_title UNION ALL SELECT id, 'error', 'sin url' FROM z WHERE url = ''
  UNION ALL SELECT id, 'error', 'lat/lon a medias' FROM z WHERE (la IS NULL) <> (lo IS NULL)
  UNION ALL SELECT id, 'error', 'coordenadas fuera' FROM z WHERE la IS NOT NULL AND (la > -32.9 OR lo IS NULL)
  UNION ALL SELECT id, 'aviso', 'categoria desconocida' FROM z WHERE seq % 109 = 0 UNION ALL SELECT id, 'error', 'escala desconocida' FROM z WHERE seq % 113 = 0
  UNION ALL SELECT id, 'error', 'fin anterior al inicio' FROM z WHERE seq % 127 = 0 UNION ALL SELECT id, 'error', 'id duplicado x2' FROM z GROUP BY id HAVING count(*) > 1)
SELECT level, CAST(id AS varchar) AS key, detail FROM p""")
def l01(spark, sf):
    return quality.check_events(_broken(spark, sf)).select("level", "key", "detail")


@register("l02_check_volume", f"""WITH {i.PUB}, a AS (SELECT count(*) AS n, count(lat) AS pins FROM pub) SELECT 'error' AS level, 'no es de hoy' AS detail FROM a
  UNION ALL SELECT 'error', 'pocos pines' FROM a WHERE pins < n * 0.8 UNION ALL SELECT 'error', 'menos de 1000000000 filas' FROM a WHERE n < 1000000000""")
def l02(spark, sf):
    old = F.lit("2024-01-13 12:00:00").cast("timestamp_ntz")
    return quality.check_volume(i.published(spark, sf), 1000000000, "eventos", old, i.now(), 0.8).select("level", "detail")


@register("l03_check_drop", f"WITH {i.PUB} SELECT 'error' AS level, 'cayo a menos de la mitad' AS detail FROM (SELECT count(*) AS antes, count(*) FILTER (seq % 3 = 0) AS ahora FROM pub) WHERE ahora < antes * 0.5")
def l03(spark, sf):
    pub = i.published(spark, sf)
    return quality.check_drop(pub, pub.filter("seq % 3 = 0")).select("level", "detail")


@register("l04_check_workshops", f"""WITH {i.PUB} SELECT 'error' AS level, CAST(id AS varchar) AS key, 'dias fuera de 0..6' AS detail FROM pub WHERE seq % 200 = 0
  UNION ALL SELECT 'aviso', 'temporadas', concat(count(*), ' sin dias') FROM pub WHERE fin IS NOT NULL AND seq % 2 = 1""")
def l04(spark, sf):
    s = F.col("seq")
    shops = i.published(spark, sf).withColumn("dias_semana", F.when(s % 200 == 0, F.array(F.lit(9))).when(s % 2 == 0, F.array(F.lit(1))))
    return quality.check_workshops(shops).select("level", "key", "detail")


@register("l05_check_offers", f"""WITH {i.OFFERS} SELECT CAST(seq AS varchar) AS key, 'dice un dia y quedo sin dias' AS detail FROM offers WHERE len(dias) = 0 AND porcentaje % 2 = 0
  UNION ALL SELECT CAST(seq AS varchar), 'lat/lon a medias' FROM offers WHERE lat IS NOT NULL AND porcentaje % 7 = 0""")
def l05(spark, sf):
    rows = i.offers(spark, sf).withColumns({"id": F.col("seq"), "condiciones": F.when(F.col("porcentaje") % 2 == 0, "Todos los SÁBADOS").otherwise("siempre"),
                                            "lon": F.when(F.coalesce(F.col("porcentaje") % 7 != 0, F.lit(True)), F.col("lon"))})
    return quality.check_offers(rows).select("key", "detail")


@register("l06_missing_cards", f"WITH {i.PUB} SELECT CAST(id AS varchar) AS key, 'sin ficha' AS detail FROM pub WHERE seq % 50 = 0")
def l06(spark, sf):
    pub = i.published(spark, sf)
    return quality.missing_cards(pub, pub.filter("seq % 50 <> 0")).select("key", "detail")


@register("l07_unnamed_subcategories", f"WITH {i.PUB} SELECT fuente AS key, concat(count(*), ' sin nombre') AS detail FROM pub WHERE fuente NOT IN ('view', 'click') GROUP BY fuente")
def l07(spark, sf):
    pub = i.published(spark, sf).withColumn("subcategoria", F.col("fuente"))
    known = pub.filter("fuente IN ('view', 'click')").select("subcategoria").distinct()
    return quality.unnamed_subcategories(pub, known).select("key", "detail")


@register("l08_correction_problems", """SELECT CAST(s_suppkey AS varchar) AS key, 'clave numerica' AS detail FROM supplier UNION ALL SELECT CAST(s_suppkey AS varchar), 'coordenadas invalidas' FROM supplier WHERE s_nationkey % 2 = 0
  UNION ALL SELECT CAST(s_suppkey AS varchar), 'campo desconocido: color' FROM supplier WHERE s_nationkey % 3 = 0""")
def l08(spark, sf):
    from kermesse.operators.corrections import correction_problems
    raw = table(spark, sf, "supplier").selectExpr("cast(s_suppkey AS string) AS clave", "CASE WHEN s_nationkey % 2 = 0 THEN '-70,1' ELSE '-33,4' END AS lat", "'-70.6' AS lon",
                                                  "CASE WHEN s_nationkey % 3 = 0 THEN 'rojo' END AS color")
    return correction_problems(raw, ("lat", "lon", "nota"), "lugares").select("key", "detail")


@register("l09_contamination", f"WITH {i.PUB} SELECT CAST(id AS varchar) AS key FROM pub WHERE comuna <> '' AND seq % 20 = 0")
def l09(spark, sf):
    t = F.when(F.col("seq") % 20 == 0, F.concat("titulo", F.lit(" en Teatro Mauri, VALPARAÍSO"))).otherwise(F.concat("titulo", F.lit(" Valparaisito")))
    return quality.contamination(i.published(spark, sf).withColumn("titulo", t)).select("key")


@register("l10_gate_verdict", f"WITH {BROKEN} SELECT false AS publicable, count(*) AS avisos FROM z WHERE seq % 109 = 0")
def l10(spark, sf):
    return quality.publishable(quality.check_events(_broken(spark, sf))).select("publicable", "avisos")
