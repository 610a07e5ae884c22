"""Golden cases of the scalar functions and the label rules."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kermesse.functions import cards, dates, labels, money, offers, places, text

AS_OF = F.lit("2026-08-11").cast("date")


def check(spark, fn, cases):
    """Run a one-column function over all inputs at once and compare."""
    rows = [(i, *(c[0] if isinstance(c[0], tuple) else (c[0],))) for i, c in enumerate(cases)]
    width = len(rows[0]) - 1
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"c{k} string" for k in range(width)))
    got = {r.i: r.v for r in df.select("i", fn(*[F.col(f"c{k}") for k in range(width)]).alias("v")).collect()}
    for i, case in enumerate(cases):
        assert got[i] == case[1], f"{case[0]!r}: {got[i]!r} != {case[1]!r}"


def test_dates(spark):
    check(spark, lambda c: dates.parse_date_es(c, AS_OF), [
        ("del 2 de julio al 5 de septiembre", datetime(2026, 7, 2)),
        ("11 Julio, 2026", datetime(2026, 7, 11)),
        ("20270315", datetime(2027, 3, 15)),
        ("2027-03-15T20:30", datetime(2027, 3, 15, 20, 30)),
        ("del 3 al 28 de febrero", datetime(2027, 2, 3)),
        ("Sábado 15 de marzo, 19:30 hrs", datetime(2027, 3, 15, 19, 30)),
        ("31/02/2027 y 15/03/2027", datetime(2027, 3, 15)),
        ("20260315", datetime(2026, 3, 15)),
        ("15/03/26", datetime(2026, 3, 15)),
        ("29 de febrero", None),
        ("jueves 20 de agosto a las 20 horas", datetime(2026, 8, 20, 20)),
        ("boletería 10:00. El 20 de agosto, a las 21.15 hrs", datetime(2026, 8, 20, 21, 15)),
        ("20271301 y 2027-03-15", datetime(2027, 3, 15)),
        ("nada por aquí", None), ("", None), (None, None)])
    check(spark, lambda c: dates.parse_date_es(c, AS_OF, F.lit("2026-07-20").cast("timestamp_ntz")),
          [("5 de julio", datetime(2026, 7, 5))])


def test_published_and_iso(spark):
    check(spark, lambda c: dates.parse_published(c, AS_OF), [
        ("Wed, 05 Aug 2026 18:43:05 +0000", datetime(2026, 8, 5, 18, 43, 5)),
        ("2026-08-05T10:00:00+00:00", datetime(2026, 8, 5, 10, 0)), ("", None)])
    check(spark, dates.iso_date, [("2026-08-31T23:59Z", date(2026, 8, 31)), ("x", None)])


def test_weekdays(spark):
    check(spark, dates.parse_weekdays, [("Lu-Mi-Vi", [0, 2, 4]),
                                        ("Lunes, Miércoles y Viernes", [0, 2, 4]), ("nada", [])])
    check(spark, dates.weekdays_from_title, [("Nado Libre Lu-Mi-Vi 06:00 h.", [0, 2, 4]),
                                             ("Taller lu a vi 10:00", [0, 1, 2, 3, 4]),
                                             ("Yoga sábados", [5]), ("Nada", [])])
    check(spark, dates.parse_time, [("19.00 hrs", "19:00"), ("9:30 a 11:00", "09:30"), ("x", None)])
    days = F.array(F.lit(0), F.lit(2), F.lit(4))
    check(spark, lambda a, b: dates.cadence_phrase(days, a, b), [
        (("19:00", "20:30"), "todos los lunes, miércoles y viernes de 19:00 a 20:30"),
        (("19:00", ""), "todos los lunes, miércoles y viernes a las 19:00")])
    check(spark, lambda a, b: dates.date_from_weekday_and_day(a.cast("int"), b.cast("int"), AS_OF),
          [(("3", "13"), date(2026, 8, 13)), (("0", "13"), None)])


def test_sessions(spark):
    sat = F.array(F.lit(5))
    row = spark.range(1).select(
        dates.future_sessions(sat, F.lit("10:00"), F.lit("2026-03-01").cast("date"),
                              F.lit("2026-08-25").cast("date"), AS_OF).alias("s"),
        dates.session_range(sat, F.lit("2026-08-01").cast("date"), F.lit("2026-08-31").cast("date"),
                            F.lit("10:00")).alias("r"),
        dates.next_session(sat, F.lit("2026-03-07 10:00:00").cast("timestamp_ntz"),
                           F.lit("2026-12-01 10:00:00").cast("timestamp_ntz"), AS_OF).alias("n")).first()
    assert row.s == [datetime(2026, 8, 15, 10), datetime(2026, 8, 22, 10)]
    assert (row.r.first, row.r.last) == (datetime(2026, 8, 1, 10), datetime(2026, 8, 29, 10))
    assert row.n == datetime(2026, 8, 15, 10)


def test_prices(spark):
    check(spark, lambda c: F.to_json(money.parse_price_clp(c), {"ignoreNullFields": "false"}), [
        ("Entrada $5.000", '{"price":5000,"free":false,"note":"Entrada $5.000"}'),
        ("gratis hasta agotar cupos", '{"price":0,"free":true,"note":"gratis hasta agotar cupos"}'),
        ("consultar en boletería", '{"price":null,"free":null,"note":""}'),
        ("Batalla freestyle $5.000", '{"price":5000,"free":false,"note":"Batalla freestyle $5.000"}'),
        ("vale 12.500 pesos", '{"price":12500,"free":false,"note":"vale 12.500 pesos"}')])
    check(spark, lambda c: money.parse_price_clp(c, word_bounds=False)["free"],
          [("Batalla freestyle $5.000", True)])
    check(spark, money.percent_in, [("Hasta un 40% · 10% en bebidas", 40), ("20 dcto", 20), ("95%", None)])
    check(spark, money.cap_amount, [("tope máximo de $20.000 por mesa", 20000), ("sin", None)])


def test_text(spark):
    check(spark, text.strip_html, [('[vc_column width="1/1"] Taller', "Taller"),
                                   ("Rock &#038; Roll", "Rock & Roll"), ("<b>a</b>&nbsp;b", "a b"),
                                   (None, "")])
    check(spark, text.fold_text, [("ÁÉÍ Ñandú ÜÇ", "aei nandu uc"), ("e\u0301", "e")])
    check(spark, lambda c: text.summarise(c, 10), [("uno dos tres cuatro", "uno dos…"), ("uno", "uno")])
    check(spark, text.clean_title_schedule, [("Nado Libre Lu-Mi-Vi 06:00 h.", "Nado Libre"),
                                             ("Concierto", "Concierto")])
    check(spark, text.title_base, [("Yoga Lu-Mi 09:00", "yoga"), ("Yoga Ma-Ju 19:30 h.", "yoga")])
    check(spark, text.venue_from_title, [
        (("Yoga Ma-Ju 09:45 h. / JJVV Villa Frei", "Deporte Vecinal"), "JJVV Villa Frei"),
        (("Yoga / Sede", "Teatro UC"), "")])
    check(spark, text.is_public_url, [("java\tscript:alert(1)", False), ("//x.cl", False),
                                      ("http://x.cl", True), (None, False)])
    check(spark, text.is_machine_url, [("https://x.cl/sitemap_1.xml", True), ("https://x.cl/feed/", True),
                                       ("https://x.cl/evento", False)])
    check(spark, text.normalise_url, [("www.quotidien.cl", "https://www.quotidien.cl"), ("vacio", ""),
                                      ("//a.cl", "https://a.cl"), ("hola", "")])
    check(spark, text.url_host, [("https://www.A.cl/x?y", "a.cl"), ("nada", "")])
    check(spark, text.html_escape, [("<a href='x'>&\"", "&lt;a href=&#39;x&#39;&gt;&amp;&quot;")])
    check(spark, text.script_safe_json, [("</script>&\u2028", "\\u003c/script\\u003e\\u0026\\u2028")])
    check(spark, text.classify_error, [("x Read timed out y", "read_timeout"), ("otra", "otra")])


def test_keys(spark):
    check(spark, lambda t, d, p: text.event_key(t, d.cast("timestamp_ntz"), p), [
        (("Entrevista con el vampiro", "2026-08-25", "Cine Arte Normandie"), "01ebd981316a427d"),
        (("No sé qué rima con te quiero", "2026-09-03", "Sala Tessier"), "1ab5366028758a4b"),
        (("Los niños del Winnipeg", "2026-09-03", "Teatro UC"), "25c8978d78200779")])


def test_areas(spark):
    check(spark, places.detect_area, [("Inmaculado Corazón de María", ""), ("la danza del oso", ""),
                                      ("Santiago, Quinta Normal", "Santiago"), ("en ÑUÑOA", "Ñuñoa")])
    check(spark, places.normalise_street, [("Av. Diecinueve de Abril", "avenida 19 de abril")])
    check(spark, lambda c: F.to_json(places.address_candidates(c)), [
        ("Guanaco Norte # 1250 Capilla Santa Inés", '[{"street":"guanaco norte","number":1250}]'),
        ("Santa Isabel 0350", "[]"),
        ("JJ VV Simon Bolivar 12 Av. Las Torres # 840",
         '[{"street":"jj vv simon bolivar 12 avenida las torres","number":840},'
         '{"street":"jj vv simon bolivar","number":12}]')])
    check(spark, lambda p, a: places.match_known_venue(p, a)["name"], [
        (("Teatro Municipal de La Florida", "La Florida"), None),
        (("Sala Matucana 100", ""), "matucana 100")])
    check(spark, places.normalise_region, [("Región Metropolotana", "Metropolitana"), ("RM", "Metropolitana"),
                                           ("Región de Ñuble", "Ñuble"), ("", "")])
    check(spark, lambda h: F.to_json(places.parse_branches(h)), [
        ("<li>VACIO;IRARRAZAVAL #3313;Región Metropolitana;ÑUÑOA;VACIO</li>",
         '[{"address":"IRARRAZAVAL #3313","region":"Metropolitana","area":"Ñuñoa"}]')])
    check(spark, lambda h: F.to_json(places.offer_html_fields(h)), [
        ('<li class="direccion"><i></i> Callao 3123<br>Las Condes</li>',
         '{"address":"Callao 3123","area":"Las Condes","phone":"","site":""}')])
    check(spark, lambda t: F.to_json(places.place_from_tags(F.split(t, ","))), [
        ("metropolitana de santiago,providencia,martes", '{"area":"Providencia","region":"Metropolitana"}'),
        ("valparaiso,segmentado", '{"area":"","region":"Valparaíso"}'),
        ("coquimbo,la serena", '{"area":"La Serena","region":"Coquimbo"}')])
    check(spark, lambda c: places.coord_in_country(c, "lat"), [("-33.4", -33.4), ("-70.6", None), ("0", None)])
    check(spark, lambda c: places.coerce_coordinate(c, -34.05, -33.0), [("-33,4327", -33.4327), ("true", None),
                                                                        ("-70", None)])


def test_offers(spark):
    check(spark, offers.weekdays_in_offer, [
        ("de domingo a jueves", ["lunes", "martes", "miercoles", "jueves", "domingo"]),
        ("todos los sábados", ["sabado"]),
        ("todos los días", ["lunes", "martes", "miercoles", "jueves", "viernes", "sabado", "domingo"]),
        ("el finde", ["sabado", "domingo"]), ("siempre", [])])
    check(spark, offers.offer_label, [("2x1 en KFC", "2x1"), ("1x2", ""), ("bebida de regalo", "Con regalo"),
                                      ("combo feliz", "Combo")])
    check(spark, offers.expiry_in, [("Hasta el 31 de agosto de 2026", date(2026, 8, 31)),
                                    ("vence 05/09/2026", date(2026, 9, 5)), ("31/02/2026", None)])
    check(spark, offers.homologate_rubric, [("beneficios/sabores/cafeterias", "cafeterias"),
                                            ("comida", "restaurantes"), ("", "restaurantes"),
                                            ("Otra Cosa", "otra-cosa")])
    check(spark, offers.merchant_from_title, [("40% dcto. en Burger King", "Burger King")])
    check(spark, offers.trim_dangling_title, [("Gimnasios Pacific - Hasta un", "Gimnasios Pacific")])
    check(spark, offers.channel_in, [("presencial y delivery", "ambas"), ("rappi", "online"), ("x", "")])
    check(spark, lambda m, r: offers.cuisine_of(m, r), [
        (("Boka Sushi", ""), "japonesa"), (("Mar del Plata", ""), ""), (("Nada", "cafeteria"), "cafe")])
    check(spark, lambda a, r: offers.in_region(a, r), [
        (("Ñuñoa", ""), True), (("Talca", "Metropolitana"), False), (("", "Valparaíso"), False),
        (("", ""), True)])


CATEGORY = [
    (("Taller de pintura al óleo", "", "", "", ""), "clases"),
    (("Bienal de grabado", "", "", "", ""), "arte"),
    (("Universidad Católica vs. Estudiantes de La Plata en Claro Arena", "", "", "", ""), "deporte"),
    (("Grupo de lectura", "", "club de lectura", "", ""), "otros"),
    (("Magia Sobre Hielo Melipilla", "", "", "", ""), "familia"),
    (("Niños del Cerro", "", "", "", ""), "otros"),
    (("JUEVES LATINO VS POP", "", "fiesta", "", ""), "fiesta"),
    (("Obras extraordinarias", "", "", "Museo de Arte Contemporáneo", ""), "arte"),
    (("Hellripper", "", "", "Sala RBX", ""), "musica"),
]


def test_labels(spark):
    check(spark, lambda t, c, d, p, s: labels.classify_category(t, c, d, p, s)["label"], CATEGORY)
    check(spark, lambda c, t, p: labels.classify_subcategory(c, t, F.lit(""), F.lit(""), p, F.lit(""))["label"], [
        (("musica", "Tributo a AC/DC rock", ""), "tributo"), (("musica", "Hellripper", "Sala RBX"), "rock"),
        (("arte", "rock", ""), ""), (("fiesta", "TRAP CITY pop", ""), "urbano")])
    check(spark, lambda t, p, s: labels.classify_scale(t, p, s, F.lit(None).cast("int"), F.lit(""))["label"], [
        (("Running", "Estadio Nacional", "Talleres Deportivos X"), "under"),
        (("Karol G", "Estadio Nacional", "x"), "masivo"), (("x", "JJ. VV. Sede 3", "y"), "under"),
        (("Festival", "", ""), "masivo"), (("nada", "", ""), "")])
    check(spark, lambda t, p: labels.classify_audience(t, F.lit(""), F.lit("otros"), p, F.lit(""))["label"], [
        (("Evento para mayores de 21 años", ""), "adultos"), (("titeres", ""), "ninos"),
        (("Torneo gamer", ""), "adolescentes"), (("x", "Bar"), "todos"), (("Desde los 14 años", ""), "adolescentes")])
    check(spark, labels.drop_reason, [(("Demonios", ""), None), (("DEMO -NO REGISTRAR", ""), "evento de prueba: DEMO"),
                                      (("x", "Postulaciones abiertas"), "postulaciones")])
    check(spark, lambda t, c, s: labels.is_workshop(t, c, s, F.array().cast("array<int>"))["label"], [
        (("Taller de defensa", "deporte", ""), True), (("Corrida taller", "deporte", ""), False),
        (("x", "clases", ""), True), (("x", "musica", ""), False)])


def test_kids_and_cards(spark):
    check(spark, lambda t: F.to_json(labels.kid_adult_flags(t, F.lit(""), F.lit("todos"))), [
        ("Títeres para niños", '{"for_kids":true,"adult":false}'),
        ("Títeres de terror", '{"for_kids":false,"adult":true}')])
    ts = lambda c: c.cast("timestamp_ntz")
    none = F.array().cast("array<int>")
    check(spark, lambda a, b: F.to_json(cards.calendar_slot(ts(a), ts(b), none, AS_OF)), [
        (("2026-07-01 10:00:00", "2026-09-01 00:00:00"),
         '{"begin":"2026-08-11T00:00:00.000","finish":"2026-08-12T00:00:00.000","all_day":true}'),
        (("2026-08-20 19:30:00", None),
         '{"begin":"2026-08-20T19:30:00.000","finish":"2026-08-20T21:30:00.000","all_day":false}')])
    check(spark, lambda a: cards.price_text(F.lit(False), a.cast("int")), [("12500", "$12.500"), ("0", "—")])


@pytest.mark.parametrize("name,expected", [("hoy", (11, 11)), ("manana", (12, 12)), ("semana", (11, 18)),
                                           ("finde", (14, 16))])
def test_windows(spark, name, expected):
    lo, hi = dates.window_bounds(name, AS_OF)
    row = spark.range(1).select(F.dayofmonth(lo).alias("a"), F.dayofmonth(hi).alias("b")).first()
    assert (row.a, row.b) == expected


def test_rules_come_from_their_table(spark):
    """A curator's row before the shipped ones wins under its own name; tables with two rules in one place are refused."""
    from dataclasses import replace

    from kermesse.functions import rules as r
    shipped = r.read_rules(r.rule_table(spark).orderBy(F.rand(1)))
    assert sorted(shipped, key=lambda x: x.regla) == sorted(r.shipped(), key=lambda x: x.regla) and len({x.regla for x in shipped}) == len(shipped)
    own = r.Rule("curador.1", "categoria", "texto", "", 0, "aire_libre", "picnic", "de noche")
    row = spark.createDataFrame([("Picnic y taller",), ("Picnic de noche, taller",), ("Nada",)], "t string")
    none = F.lit("")
    got = [tuple(x.c) for x in row.select(labels.classify_category(F.col("t"), none, none, none, none, (own, *shipped)).alias("c")).collect()]
    assert got[0] == ("aire_libre", "titulo", "curador.1") and got[1][0] == "clases" and got[1][2].startswith("categoria.texto.")
    assert got[2] == ("otros", "defecto", "categoria.defecto")
    for bad in (own, replace(own, regla="curador.2")):
        with pytest.raises(ValueError):
            r.read_rules(r.rule_table(spark, [own, bad]))


def test_rule_audit_names_every_axis(spark):
    from kermesse.operators.review import rule_audit
    row = spark.createDataFrame([("Festival de jazz", "", "para toda la familia", "Movistar Arena", "x")],
                                "titulo string, categoria string, descripcion_corta string, lugar_nombre string, fuente_nombre string")
    told = {x.eje: (x.etiqueta, x.regla, x.n) for x in rule_audit(row.unionAll(row)).collect()}
    assert told["escala"] == ("masivo", "escala.recinto_masivo.01", 2) and told["publico"][0] == "ninos"
    assert told["categoria"][1].startswith("categoria.texto.") and set(told) == {"categoria", "subcategoria", "escala", "publico"}
