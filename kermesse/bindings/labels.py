"""Label rules over titles written from phrases whose label is known."""

from __future__ import annotations

from pyspark.sql import functions as F

from kermesse.bindings import inputs as i
from kermesse.bindings.registry import register, table
from kermesse.bindings.scalars import pick, sql_list
from kermesse.functions import labels, offers, rules
from kermesse.functions.text import WORD_END, WORD_START
from kermesse.operators import review
from kermesse.vocab import labels as lv

# title, source category, description, place, source -> category, reason
CATEGORY = [
    ("Taller de pintura al óleo", "", "", "", "", "clases", "titulo"),
    ("Bienal de grabado", "", "", "", "", "arte", "titulo"),
    ("Católica vs. Estudiantes en Claro Arena", "", "", "", "", "deporte", "titulo"),
    ("Grupo de lectura", "", "club de lectura", "", "", "otros", "defecto"),
    ("Magia Sobre Hielo", "", "", "", "", "familia", "titulo"),
    ("Niños del Cerro", "", "", "", "", "otros", "defecto"),
    ("Niños del Cerro", "", "tocata", "", "", "fiesta", "descripcion"),
    ("Obras extraordinarias", "", "", "Museo de Arte Contemporáneo", "", "arte", "prior"),
    ("Hellripper", "", "", "Sala RBX", "", "musica", "prior"),
    ("Noche Papi", "", "", "", "Toliv", "fiesta", "prior"),
    ("Natación para niños", "", "", "", "", "deporte", "titulo"),
    ("Feria del Libro", "Fiesta", "", "", "", "feria", "titulo"),
    ("Trekking", "", "", "", "", "aire_libre", "titulo"),
    ("Lanzamiento", "", "", "", "", "charla", "titulo"),
    ("Mundo Lingo", "", "", "", "", "idiomas", "titulo"),
    ("Ciclo documental", "", "", "", "", "cine", "titulo"),
    ("Stand up", "", "", "", "", "teatro", "titulo"),
]


def _table(spark):
    """The rules as they come back from their table."""
    return rules.read_rules(rules.rule_table(spark))


def _rows(spark, sf, phrases, width):
    k = F.col("event_id") % len(phrases)
    cols = {f"c{n}": pick([p[n] for p in phrases], k) for n in range(width)}
    return table(spark, sf, "events").withColumns(cols)


def _expected(phrases, n):
    return f"{sql_list([p[n] for p in phrases])}[event_id % {len(phrases)} + 1]"


@register("i01_classify_category", f"SELECT event_id, {_expected(CATEGORY, 5)} AS categoria, {_expected(CATEGORY, 6)} AS origen FROM events")
def i01(spark, sf):
    c = F.col
    got = labels.classify_category(F.concat_ws(" ", "c0", c("user_id").cast("string")), c("c1"), c("c2"), c("c3"), c("c4"), _table(spark))
    return _rows(spark, sf, CATEGORY, 5).select("event_id", got["label"].alias("categoria"), got["reason"].alias("origen"))


# category, title, place -> subcategory, reason
SUB = [
    ("musica", "Tributo a AC/DC rock", "", "tributo", "titulo"), ("musica", "Hellripper", "Sala RBX", "rock", "lugar"),
    ("arte", "rock", "", "", "defecto"), ("fiesta", "TRAP CITY pop", "", "urbano", "titulo"), ("fiesta", "Fonda de Cumbia", "", "cumbia", "titulo"),
    ("deporte", "Aerobike y ciclismo", "", "baile_fitness", "titulo"), ("clases", "Bachata Música", "", "danza", "titulo"),
    ("teatro", "Nada", "Carpa de circo", "circo", "lugar"), ("clases", "Arte marcial", "", "", "defecto"),
    ("fiesta", "Antonia López de Bello", "MUT Mercado Urbano", "", "defecto"), ("deporte", "Jiu-Jitsu", "", "artes_marciales", "titulo"),
]


@register("i02_classify_subcategory", f"SELECT event_id, {_expected(SUB, 3)} AS sub, {_expected(SUB, 4)} AS origen FROM events")
def i02(spark, sf):
    c, none = F.col, F.lit("")
    got = labels.classify_subcategory(c("c0"), F.concat_ws(" ", "c1", F.concat(F.lit("n"), "user_id")), none, none, c("c2"), none, _table(spark))
    return _rows(spark, sf, SUB, 3).select("event_id", got["label"].alias("sub"), got["reason"].alias("origen"))


# title, place, source -> scale
SCALE = [
    ("Running", "Estadio Nacional", "Talleres Deportivos X", "under"), ("Karol G", "Estadio Nacional", "x", "masivo"),
    ("Cuarteto en el Movistar Arena", "Disfruta", "x", "masivo"), ("Tocata", "Blondie", "x", "under"), ("Clase", "Multicancha 3", "x", "under"),
    ("Festival", "", "", "masivo"), ("Curso caro", "", "", ""), ("Cena", "", "", "precio"),
]


@register("i03_classify_scale", f"""SELECT event_id, CASE WHEN {_expected(SCALE, 3)} = 'precio' THEN CASE WHEN floor(value * 1000) > 40000 THEN 'masivo' ELSE '' END ELSE {_expected(SCALE, 3)} END AS escala FROM events""")
def i03(spark, sf):
    c = F.col
    got = labels.classify_scale(c("c0"), c("c1"), c("c2"), F.floor(c("value") * 1000).cast("int"), F.concat(F.lit("n"), "user_id"), _table(spark))
    return _rows(spark, sf, SCALE, 3).select("event_id", got["label"].alias("escala"))


# title, category, place, source -> audience at any hour / at night
AUDIENCE = [
    ("Evento para mayores de 21 años", "otros", "", "", "adultos", "adultos"), ("Apto desde los 14 años", "otros", "", "", "todos", "todos"),
    ("Desde los 14 años", "otros", "", "", "adolescentes", "adolescentes"), ("Desde los 6 años", "otros", "", "", "ninos", "ninos"),
    ("Barra libre", "otros", "", "", "adultos", "adultos"), ("Concierto", "musica", "Bar de René", "", "todos", "adultos"),
    ("Carretón", "fiesta", "Plaza", "", "todos", "adultos"), ("Noche", "fiesta", "", "Toliv", "adultos", "adultos"), ("Títeres", "teatro", "", "", "ninos", "ninos"),
    ("Torneo gamer", "otros", "", "", "adolescentes", "adolescentes"), ("Pequeño Circo infantil", "musica", "", "", "todos", "todos"),
    ("Club de lectura", "otros", "Club Central", "", "todos", "todos"), ("Robar un banco", "cine", "Sala", "", "todos", "todos"),
]
AUDIENCE[1] = ("Apto desde 14 años", "otros", "", "", "adolescentes", "adolescentes")


@register("i04_classify_audience", f"SELECT event_id, CASE WHEN hour(ts) >= 21 THEN {_expected(AUDIENCE, 5)} ELSE {_expected(AUDIENCE, 4)} END AS publico FROM events")
def i04(spark, sf):
    c = F.col
    got = labels.classify_audience(c("c0"), F.concat(F.lit("n"), "user_id"), c("c1"), c("c2"), c("c3"), F.hour("ts"), _table(spark))
    return _rows(spark, sf, AUDIENCE, 4).select("event_id", got["label"].alias("publico"))


# title, category, source -> workshop
SHOP = [("Taller de defensa", "deporte", "", "true"), ("Corrida taller", "clases", "", "false"), ("Inglés", "idiomas", "", "true"), ("Natación", "deporte", "Corporación Municipal de Deportes", "true"),
        ("Natación", "deporte", "Otra", "serie"), ("Concierto", "musica", "", "serie")]


@register("i05_is_workshop", f"SELECT event_id, CASE {_expected(SHOP, 3)} WHEN 'true' THEN true WHEN 'false' THEN false ELSE user_id % 2 = 0 END AS taller FROM events")
def i05(spark, sf):
    c = F.col
    days = F.when(c("user_id") % 2 == 0, F.array(F.lit(1)))
    return _rows(spark, sf, SHOP, 3).select("event_id", labels.is_workshop(c("c0"), c("c1"), c("c2"), days, _table(spark))["label"].alias("taller"))


# merchant, rubric -> cuisine, rubric
FOOD = [("Boka Sushi", "restaurantes", "japonesa", "restaurantes"), ("Mar del Plata", "comida", "", "restaurantes"), ("Burger Inn", "Restaurantes y Bares", "hamburguesas", "comida_rapida"),
        ("Pastelería Sur", "comida", "panaderia", "cafeterias"), ("Nada", "cafeteria", "cafe", "cafeterias"), ("Nada", "Antojos", "comida_rapida", "comida_rapida"),
        ("Valle Verde", "gourmet", "", "gourmet"), ("El Pollo Rico", "gourmet", "pollo", "gourmet"), ("Bar del Mar", "", "mariscos", "restaurantes")]


@register("i06_cuisine_and_rubric", f"""SELECT p_partkey, {sql_list([f[2] for f in FOOD])}[p_partkey % {len(FOOD)} + 1] AS cocina, {sql_list([f[3] for f in FOOD])}[p_partkey % {len(FOOD)} + 1] AS rubro FROM part""")
def i06(spark, sf):
    k = F.col("p_partkey") % len(FOOD)
    rows = table(spark, sf, "part").withColumns({"m": F.concat_ws(" ", pick([f[0] for f in FOOD], k), F.col("p_size").cast("string")), "r": pick([f[1] for f in FOOD], k)})
    rows = rows.withColumn("cocina", offers.cuisine_of(F.col("m"), F.col("r"), _table(spark)))
    return rows.select("p_partkey", "cocina", offers.rubric_of(F.col("r"), F.col("cocina")).alias("rubro"))


@register("i07_kid_adult_flags", """SELECT event_id, event_id % 4 IN (0, 3) AND event_id % 4 <> 1 AS ninos, event_id % 4 IN (1, 2) AS adulto FROM events""")
def i07(spark, sf):
    t = pick(["Títeres en familia", "Títeres de TERROR", "Cena", "Cena"], F.col("event_id") % 4)
    who = pick(["todos", "ninos", "adultos", "ninos"], F.col("event_id") % 4)
    got = labels.kid_adult_flags(t, F.concat(F.lit("n"), "user_id"), who)
    return table(spark, sf, "events").select("event_id", got["for_kids"].alias("ninos"), got["adult"].alias("adulto"))


# -- rules by name over the texts of documents

def rule_sql(text: str, axis: str, layer: str, scope: str = "") -> str:
    """The first rule that matches, as label|rule|layer; word bounds are written out, as this engine has no lookaround."""
    plain = lambda p: p.replace(WORD_START, "(?:^|[^a-z0-9])").replace(WORD_END, "(?:$|[^a-z0-9])").replace("'", "''")
    cases = [f"WHEN regexp_matches({text}, '{plain(r.patron)}')" + (f" AND NOT regexp_matches({text}, '{plain(r.salvo)}')" if r.salvo else "")
             + f" THEN '{r.etiqueta}|{r.regla}'" for r in rules.layer(None, axis, layer, scope)]
    return f"CASE {' '.join(cases)} END"


def _fold(*parts: str) -> str:
    joined = "concat(" + ", ' ', ".join(parts) + ")"
    return rf"regexp_replace(strip_accents(lower({joined})), '\s+', ' ', 'g')"


def _by_category(text: str, layer: str) -> str:
    return "CASE cat " + " ".join(f"WHEN '{k}' THEN {rule_sql(text, 'subcategoria', layer, k)}" for k in rules.scopes(None, "subcategoria", layer)) + " END"


AUDIT = f"""WITH d AS (SELECT split_part(text, chr(10), 1) AS titulo, text, coalesce(source, '') AS lugar, coalesce(lang, '') AS fuente FROM documents),
t AS (SELECT {_fold("''", "titulo")} AS h, {_fold("''", "titulo", "text")} AS b, {_fold("text")} AS x, {_fold("titulo")} AS ttl, {_fold("titulo", "text")} AS tt, {_fold("lugar", "titulo", "text")} AS big,
  {_fold("lugar", "fuente")} AS ctx, {_fold("lugar")} AS plc, {_fold("fuente")} AS src FROM d),
k AS (SELECT *, {rule_sql("h", "categoria", "texto")} AS k1, {rule_sql("b", "categoria", "texto")} AS k2, {rule_sql("ctx", "categoria", "recinto")} AS k3 FROM t),
c AS (SELECT *, coalesce(k1 || '|titulo', k2 || '|descripcion', k3 || '|prior', 'otros|categoria.defecto|defecto') AS k, split_part(coalesce(k1, k2, k3, 'otros'), '|', 1) AS cat FROM k),
r AS (SELECT 'categoria' AS eje, k AS r FROM c
  UNION ALL SELECT 'subcategoria', coalesce({_by_category("h", "texto")}, {_by_category("x", "texto")}, {_by_category("ctx", "recinto")}, '|subcategoria.defecto') FROM c
  UNION ALL SELECT 'escala', coalesce({rule_sql("src", "escala", "fuente de barrio")}, {rule_sql("big", "escala", "recinto masivo")}, {rule_sql("ctx", "escala", "recinto chico")}, {rule_sql("plc", "escala", "lugar de barrio")}, {rule_sql("ttl", "escala", "titulo")}, '|escala.defecto') FROM c
  UNION ALL SELECT 'publico', coalesce({rule_sql("tt", "publico", "nombre propio")}, CASE WHEN regexp_extract(tt, '{lv.EXPLICIT_AGE}', 1) <> '' THEN CASE WHEN regexp_extract(tt, '{lv.EXPLICIT_AGE}', 1)::int >= 18 THEN 'adultos' WHEN regexp_extract(tt, '{lv.EXPLICIT_AGE}', 1)::int >= 13 THEN 'adolescentes' ELSE 'ninos' END || '|publico.edad' END,
    {rule_sql("tt", "publico", "palabra +18")}, CASE WHEN cat = 'fiesta' AND NOT regexp_matches(tt, '{lv.READING_CLUB}') THEN {rule_sql("plc", "publico", "recinto nocturno")} END, {rule_sql("tt", "publico", "palabra infantil")}, {rule_sql("tt", "publico", "palabra juvenil")}, 'todos|publico.defecto') FROM c)
SELECT eje, split_part(r, '|', 2) AS regla, split_part(r, '|', 1) AS etiqueta, split_part(r, '|', 3) AS capa, count(*) AS n FROM r GROUP BY ALL"""


def document_events(spark, sf):
    """Documents as rows to be labelled: the first line is the title, the whole text the description."""
    text, none = F.coalesce("text", F.lit("")), F.lit("")
    return table(spark, sf, "documents").select(
        F.split_part(text, F.lit("\n"), F.lit(1)).alias("titulo"), none.alias("categoria"), text.alias("descripcion_corta"),
        F.coalesce("source", none).alias("lugar_nombre"), F.coalesce("lang", none).alias("fuente_nombre"))


@register("i08_rules_over_documents", AUDIT)
def i08_documents(spark, sf):
    return review.rule_audit(document_events(spark, sf), _table(spark))


def _audited(spark, sf):
    r = _rows(spark, sf, CATEGORY, 5)
    return r.select(F.col("c0").alias("titulo"), F.col("c1").alias("categoria"), F.col("c2").alias("descripcion_corta"), F.col("c3").alias("lugar_nombre"), F.col("c4").alias("fuente_nombre"))


@register("i08_rule_audit", f"SELECT {_expected(CATEGORY, 6)} AS origen, {_expected(CATEGORY, 5)} AS etiqueta, count(*) AS n FROM events GROUP BY 1, 2")
def i08(spark, sf):
    told = review.rule_audit(_audited(spark, sf), _table(spark)).filter("eje = 'categoria'")
    return told.groupBy(F.col("capa").alias("origen"), "etiqueta").agg(F.sum("n").alias("n"))


@register("d15_category_origin_breakdown", f"SELECT CASE WHEN o IN ('titulo', 'descripcion') THEN 'texto' ELSE o END AS origen, count(*) AS n FROM (SELECT {_expected(CATEGORY, 6)} AS o FROM events) GROUP BY 1")
def d15(spark, sf):
    return review.origin_breakdown(_audited(spark, sf))


STATUS = f"""WITH run AS (SELECT event_type AS nombre, count(*) AS n FROM events WHERE CAST(ts AS date) = DATE '2024-01-16' GROUP BY 1),
cfg AS (SELECT DISTINCT concat(event_type, CASE WHEN user_id % 2 = 0 THEN '' ELSE ' vieja' END) AS nombre FROM events)
SELECT cfg.nombre, CASE WHEN cfg.nombre LIKE '%vieja' AND cfg.nombre LIKE 'c%' THEN 'apagada' WHEN run.n IS NULL THEN 'no corrio' WHEN cfg.nombre = 'error' THEN 'error' WHEN cfg.nombre = 'view' THEN 'trajo cero'
  WHEN cfg.nombre = 'signup' THEN 'sin nada futuro' ELSE 'extrajo' END AS estado, (SELECT count(*) FROM events WHERE event_type = cfg.nombre) AS en_sitio FROM cfg LEFT JOIN run USING (nombre)"""


def _status(spark, sf):
    ev = table(spark, sf, "events")
    config = ev.selectExpr("concat(event_type, CASE WHEN user_id % 2 = 0 THEN '' ELSE ' vieja' END) AS nombre").distinct().selectExpr(
        "nombre", "'json' AS tipo_adaptador", "NOT (nombre LIKE '%vieja' AND nombre LIKE 'c%') AS activa")
    runs = ev.selectExpr("event_type AS fuente", "ts AS momento", "CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS encontrados", "0 AS nuevos", "0 AS actualizados", "0 AS descartados",
                         "CASE WHEN event_type = 'error' THEN 'x' END AS error")
    latest = review.latest_run_per_source(runs, F.lit("2024-01-16"))
    kept = i.candidates(spark, sf).filter("fuente_nombre <> 'signup'")
    return review.source_status_catalogue(config, latest, i.published(spark, sf), review.stale_sources(latest, kept, i.as_of()))


@register("c17_source_status_catalog", STATUS)
def c17(spark, sf):
    return _status(spark, sf).select("nombre", "estado", "en_sitio")


@register("f04_status_order", STATUS.replace("SELECT cfg.nombre, CASE", "SELECT nombre, estado FROM (SELECT cfg.nombre, CASE") + ")")
def f04(spark, sf):
    return review.status_order(_status(spark, sf)).select("nombre", "estado")


@register("c18_attach_domain_failures", """WITH f AS (SELECT event_type AS host, ts, event_id FROM events WHERE user_id % 3 <> 0 AND ts >= TIMESTAMP '2024-01-10')
SELECT event_type AS nombre, (SELECT count(*) FROM f WHERE host = event_type) AS caidas,
  (SELECT first(CASE WHEN event_id % 2 = 0 THEN 'read_timeout' ELSE 'refused' END ORDER BY ts) FROM f WHERE host = event_type) AS causa FROM (SELECT DISTINCT event_type FROM events)""")
def c18(spark, sf):
    ev = table(spark, sf, "events")
    sources = ev.select(F.col("event_type").alias("nombre")).distinct().withColumn("url_base", F.concat(F.lit("https://www."), "nombre", F.lit("/x")))
    log = ev.selectExpr("ts", "concat('http://', event_type, '/p?', event_id) AS url", "user_id % 3 = 0 AS ok", "CASE WHEN event_id % 2 = 0 THEN 'Read timed out' ELSE 'Connection refused' END AS message")
    return review.attach_domain_failures(sources, log, F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).select("nombre", "caidas", "causa")


@register("c19_set_difference_ids", "SELECT DISTINCT user_id AS id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 400)")
def c19(spark, sf):
    from kermesse.operators.quality import missing_cards
    ev = table(spark, sf, "events").select(F.col("user_id").alias("id"), "event_type", "value")
    return missing_cards(ev.select("id").distinct(), ev.filter("event_type = 'purchase' AND value > 400")).select(F.col("key").cast("bigint").alias("id"))


