"""Predicates and filters over the derived candidates and offers."""

from __future__ import annotations

from pyspark.sql import functions as F

from kermesse.bindings import inputs as i
from kermesse.bindings.registry import register, table
from kermesse.functions import offers as ofn
from kermesse.functions import places, text
from kermesse.operators import filters

VALID = """CASE WHEN length(titulo) < 3 THEN 'sin titulo' WHEN fuente_url = '' THEN 'sin link a la fuente'
  WHEN fuente_url NOT LIKE 'http%' THEN 'el link no es http(s)' WHEN fuente_url LIKE '%/api/%' THEN 'el link es un endpoint'
  WHEN CAST(coalesce(fin, inicio) AS date) < DATE '2024-01-15' THEN 'evento pasado' END"""


@register("b01_validate_with_reason", f"WITH {i.CAND} SELECT seq, {VALID} AS motivo FROM cand")
def b01(spark, sf):
    return filters.validate(i.candidates(spark, sf), i.as_of()).select("seq", "motivo")


PAGE_URLS = """CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN concat('java', chr(9), 'script:', url) WHEN 2 THEN substr(url, strpos(url, ':') + 1)
  WHEN 3 THEN concat('  HTTP', substr(url, strpos(url, ':'))) ELSE 'ficha/3' END"""


def _page_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.expr(
        PAGE_URLS.replace("strpos(url, ':')", "instr(url, ':')")).alias("u"))


@register("b02_is_public_url", "SELECT page_id, page_id % 5 IN (0, 3) AS publica FROM pages")
def b02(spark, sf):
    return _page_urls(spark, sf).select("page_id", text.is_public_url(F.col("u")).alias("publica"))


@register("b03_is_machine_url", """SELECT event_id, event_id % 8 < 6 AS maquina FROM events""")
def b03(spark, sf):
    forms = ["/sitemap_3.xml", "/rss/x.RSS", "/feed/", "/wp-json/v2", "/api/x", "/x.json?a=1", "/evento/feed/x", "/x.jsonl"]
    url = F.concat(F.lit("https://x.cl/"), F.col("event_id").cast("string"),
                   F.get(F.array(*[F.lit(f) for f in forms]), (F.col("event_id") % 8).cast("int")))
    return table(spark, sf, "events").select("event_id", text.is_machine_url(url).alias("maquina"))


@register("b04_keyword_gate", f"""WITH {i.CAND} SELECT seq, CASE fuente_nombre
  WHEN 'click' THEN CASE WHEN regexp_matches(titulo, '(^|[^a-z0-9])3([^a-z0-9]|$)') OR descripcion_corta = 'nota 3' THEN 'palabra excluida: 3' END
  WHEN 'view' THEN CASE WHEN NOT (regexp_matches(titulo, ' (1|2)$') OR descripcion_corta IN ('nota 1', 'nota 2')) THEN 'no menciona ninguna palabra del filtro' END
  END AS motivo FROM cand""")
def b04(spark, sf):
    config = spark.createDataFrame([("click", [], ["3", "zz"]), ("view", ["1", "2"], []), ("error", None, None)],
                                   "fuente_nombre string, inc array<string>, exc array<string>")
    rows = i.candidates(spark, sf).join(config, "fuente_nombre", "left")
    return rows.select("seq", filters.keyword_reason(F.col("inc"), F.col("exc")).alias("motivo"))


@register("b05_require_area", f"""WITH {i.CAND} SELECT seq, coalesce({VALID}, CASE WHEN fuente_nombre = 'view' AND comuna = '' THEN 'sin comuna' END) AS motivo FROM cand""")
def b05(spark, sf):
    config = spark.createDataFrame([("view", True, None, None), ("click", False, None, None)],
                                   "fuente_nombre string, requiere_comuna boolean, filtro_palabras array<string>, descartar_palabras array<string>")
    return filters.gate(i.candidates(spark, sf), config, i.as_of()).select("seq", "motivo")


@register("b06_is_current", f"WITH {i.CAND} SELECT seq FROM cand WHERE CAST(coalesce(fin, inicio) AS date) >= DATE '2024-01-15'")
def b06(spark, sf):
    return i.candidates(spark, sf).filter(filters.is_current(F.col("inicio"), F.col("fin"), i.as_of())).select("seq")


@register("b07_drop_non_events", """SELECT doc_id FROM documents WHERE NOT regexp_matches(lower(concat(CASE WHEN doc_id % 3 = 0 THEN 'TEST ' ELSE 'atest ' END, source)), '(^|[^a-záéíóúñ])test([^a-záéíóúñ]|$)')
  AND NOT contains(lower(concat(CASE WHEN doc_id % 3 = 0 THEN 'TEST ' ELSE 'atest ' END, source, ' ', text, CASE WHEN doc_id % 4 = 0 THEN ' Vacante' ELSE '' END)), 'vacante')""")
def b07(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.when(F.col("doc_id") % 3 == 0, "TEST ").otherwise("atest "), "source").alias("titulo"),
        F.concat("text", F.when(F.col("doc_id") % 4 == 0, " Vacante").otherwise("")).alias("descripcion_corta"))
    return filters.drop_non_events(docs).select("doc_id")


@register("b08_offer_alive", f"WITH {i.OFFERS} SELECT seq FROM offers WHERE vigencia_hasta IS NULL OR vigencia_hasta >= DATE '{i.OFFER_AS_OF}'")
def b08(spark, sf):
    return i.offers(spark, sf).filter(filters.offer_alive(F.col("vigencia_hasta"), F.lit(i.OFFER_AS_OF))).select("seq")


IN_REGION = "CASE WHEN comuna <> '' THEN comuna <> 'Talca' ELSE region IN ('', 'Metropolitana') END"


@register("b09_offer_in_region", f"WITH {i.OFFERS} SELECT seq FROM offers WHERE {IN_REGION}")
def b09(spark, sf):
    return i.offers(spark, sf).filter(ofn.in_region(F.col("comuna"), F.col("region"))).select("seq")


@register("b10_exclude_merchants", f"""WITH {i.OFFERS} SELECT seq FROM offers WHERE comercio <> '' AND NOT EXISTS (
  SELECT 1 FROM part WHERE p_partkey % 10 = 0 AND p_brand = banco_id AND lower(trim(p_name)) = lower(trim(comercio)))""")
def b10(spark, sf):
    excluded = table(spark, sf, "part").filter("p_partkey % 10 = 0").select(
        F.col("p_brand").alias("banco_id"), F.upper("p_name").alias("comercio"))
    return filters.exclude_merchants(i.offers(spark, sf), excluded).select("seq")


@register("b11_in_bbox", f"""WITH {i.CAND} SELECT seq, coalesce(lat > -33.45 AND lat < -33.40 AND lon > -70.64 AND lon < -70.59, false) AS dentro FROM cand""")
def b11(spark, sf):
    return i.candidates(spark, sf).select("seq", places.in_bbox(
        F.col("lat"), F.col("lon"), (-33.45, -33.40, -70.64, -70.59)).alias("dentro"))


@register("b12_null_half_coordinate", f"""WITH {i.CAND} SELECT seq, CASE WHEN seq % 7 = 0 THEN NULL ELSE lat END AS lat,
  CASE WHEN seq % 7 = 0 THEN NULL ELSE lon END AS lon FROM cand""")
def b12(spark, sf):
    half = i.candidates(spark, sf).withColumn("lat", F.when(F.col("seq") % 7 != 0, F.col("lat")))
    return filters.null_half_coordinate(half).select("seq", "lat", "lon")


@register("b13_coerce_coordinate", """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN -33.0 - (c_custkey % 90 + 1) / 100.0e0 WHEN 1 THEN -33.5e0 END AS lat FROM customer""")
def b13(spark, sf):
    n = F.col("c_custkey") % 90 + 1
    raw = (F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("-33,"), F.lpad(n.cast("string"), 2, "0")))
           .when(F.col("c_custkey") % 4 == 1, F.lit(" -33.5 ")).when(F.col("c_custkey") % 4 == 2, F.lit("true"))
           .otherwise(F.lit("-70.1")))
    return table(spark, sf, "customer").select("c_custkey", F.round(places.coerce_coordinate(raw, -34.05, -33.00), 6).alias("lat"))


@register("b14_search_all_words", """SELECT doc_id FROM documents WHERE contains(strip_accents(lower(concat(text, ' ', source))), 'tion')
  AND contains(strip_accents(lower(concat(text, ' ', source))), 'src1')""")
def b14(spark, sf):
    return table(spark, sf, "documents").filter(
        filters.search_all_words("TIÓN Src1", F.col("text"), F.col("source"))).select("doc_id")


SERIES = """series AS (SELECT event_id AS seq, ts AS inicio, CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN ts + interval '10' day ELSE ts + interval '25' day END AS fin,
  CASE WHEN event_id % 2 = 0 THEN user_id % 7 END AS dia FROM events)"""


def _series(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id AS seq", "ts AS inicio", "CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN ts + interval '10' day ELSE ts + interval '25' day END AS fin",
        "CASE WHEN event_id % 2 = 0 THEN array(cast(user_id % 7 as int)) END AS dias")


def _window_sql(lo: str, hi: str) -> str:
    return f"""WITH {SERIES} SELECT seq FROM series WHERE CASE
      WHEN dia IS NOT NULL THEN EXISTS (SELECT 1 FROM generate_series(DATE '{lo}', DATE '{hi}', INTERVAL 1 DAY) g(d)
        WHERE isodow(d) - 1 = dia AND CAST(d AS date) >= CAST(inicio AS date) AND CAST(d AS date) <= CAST(coalesce(fin, inicio) AS date))
      WHEN fin IS NOT NULL THEN CAST(inicio AS date) <= DATE '{hi}' AND CAST(fin AS date) >= DATE '{lo}'
      ELSE CAST(inicio AS date) BETWEEN DATE '{lo}' AND DATE '{hi}' END"""


for _name, _lo, _hi in (("finde", "2024-01-19", "2024-01-21"), ("semana", "2024-01-15", "2024-01-22")):
    @register(f"b15_in_date_window_{_name}", _window_sql(_lo, _hi))
    def b15(spark, sf, name=_name):
        return _series(spark, sf).filter(filters.in_date_window(
            name, F.col("inicio"), F.col("fin"), F.col("dias"), i.as_of())).select("seq")


@register("b16_time_band", f"""WITH {i.CAND} SELECT seq FROM cand WHERE (hour(inicio) = 0 AND minute(inicio) = 0) OR hour(inicio) BETWEEN 12 AND 17""")
def b16(spark, sf):
    return i.candidates(spark, sf).filter(filters.time_band(F.col("inicio"), "tarde")).select("seq")


@register("b17_price_cap", f"WITH {i.CAND} SELECT seq FROM cand WHERE coalesce(es_gratis, false) OR coalesce(precio_clp <= 10000, false)")
def b17(spark, sf):
    return i.candidates(spark, sf).filter(filters.price_cap(F.col("es_gratis"), F.col("precio_clp"), 10000)).select("seq")


@register("b18_audience_inclusive", f"""WITH {i.PUB} SELECT seq, publico IN ('ninos', 'todos') AS ninos, publico NOT IN ('ninos', 'adultos') AS adolescentes,
  publico = 'adultos' AS adultos FROM pub""")
def b18(spark, sf):
    return i.published(spark, sf).select("seq", *[filters.audience_inclusive(F.col("publico"), w).alias(w)
                                                  for w in ("ninos", "adolescentes", "adultos")])


@register("b19_within_radius", f"""WITH {i.PUB} SELECT seq FROM pub WHERE lat IS NOT NULL AND precision NOT IN ('comuna', 'sin_ubicar')
  AND sqrt(power((lat + 33.44) * 111, 2) + power((lon + 70.65) * 92, 2)) <= 3""")
def b19(spark, sf):
    return i.published(spark, sf).filter(filters.within_radius(
        F.col("lat"), F.col("lon"), F.col("precision"), (-33.44, -70.65), 3)).select("seq")


@register("b20_offer_valid_on_day", f"WITH {i.OFFERS} SELECT seq FROM offers WHERE len(dias) = 0 OR list_contains(dias, 'martes')")
def b20(spark, sf):
    return i.offers(spark, sf).filter(ofn.valid_on_day(F.col("dias"), F.lit("1998-06-16"))).select("seq")


@register("b21_season_running", f"""WITH {SERIES} SELECT seq FROM series WHERE dia IS NULL AND CAST(inicio AS date) < DATE '2024-01-15' AND CAST(fin AS date) >= DATE '2024-01-15'""")
def b21(spark, sf):
    from kermesse.functions.cards import season_running
    return _series(spark, sf).filter(season_running(F.col("inicio"), F.col("fin"), F.col("dias"), i.as_of())).select("seq")


@register("b22_is_food_offer", """SELECT p_partkey, p_partkey % 4 < 2 AS comida FROM part""")
def b22(spark, sf):
    words = F.array(*[F.lit(w) for w in ("Restaurantes y bares", "CAFETERÍA", "gimnasios", "viajes")])
    t = F.concat_ws(" ", F.get(words, (F.col("p_partkey") % 4).cast("int")), F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", ofn.is_food_offer(t).alias("comida"))


@register("b23_is_real_place", f"""WITH {i.PUB} SELECT seq FROM pub WHERE seq % 3 <> 1""")
def b23(spark, sf):
    name = F.when(F.col("seq") % 3 == 1, F.concat(F.lit("PuntoTicket "), "lugar")).otherwise(F.col("lugar"))
    return i.published(spark, sf).filter(filters.is_real_place(name)).select("seq")

