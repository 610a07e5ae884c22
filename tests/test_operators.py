"""Operators against brute force and golden cases on small fixtures."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kermesse.bindings import inputs
from kermesse.operators import collapse, corrections, offers, quality, recommend, review, skew, store
from kermesse.schemas import CANDIDATE, STORE, conform, names

AS_OF = F.lit("2026-08-11").cast("date")
NOW = F.lit("2026-08-11 09:00:00").cast("timestamp_ntz")


def candidates(spark, rows):
    """Rows of dicts; anything unsaid is blank."""
    base = {n: None for n in names(CANDIDATE)} | {"titulo": "Muestra", "lugar_nombre": "Sala", "precio_texto": "", "imagen_url": "",
                                                  "comuna": "", "fuente_nombre": "f", "fuente_url": "https://x.cl/1", "todo_el_dia": False}
    full = [tuple((base | {"seq": i} | r)[n] for n in names(CANDIDATE)) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, CANDIDATE)


def day(n, hour=0):
    return datetime(2026, 8, n, hour)


def test_collapse_golden(spark):
    df = candidates(spark, [{"inicio": day(d)} for d in (1, 2, 3, 8)] + [{"inicio": None}])
    got = sorted((r.inicio, r.fin, r.todo_el_dia) for r in collapse.collapse_multiday(df).collect() if r.inicio)
    assert got == [(day(1), day(3), True), (day(8), None, False)]
    assert collapse.collapse_multiday(df).filter("inicio is null").count() == 1
    saturdays = candidates(spark, [{"inicio": day(d, 20)} for d in (1, 8, 15)])
    assert collapse.collapse_multiday(saturdays).count() == 3
    four = candidates(spark, [{"inicio": day(1)}, {"inicio": day(5)}])
    assert collapse.collapse_multiday(four).count() == 1


def test_collapse_ignores_row_order_and_repeats(spark):
    rng = random.Random(7)
    rows = [{"seq": i, "titulo": f"t{rng.randint(0, 3)}", "inicio": day(rng.randint(1, 28), rng.randint(0, 2)),
             "precio_clp": rng.choice([None, 1000, 2000]), "imagen_url": rng.choice(["", "a", "b"])} for i in range(120)]
    once = collapse.collapse_multiday(candidates(spark, rows))
    rng.shuffle(rows)
    again = collapse.collapse_multiday(candidates(spark, rows))
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    twice = collapse.collapse_multiday(once)
    assert sorted((r.titulo, r.inicio) for r in twice.collect()) == sorted((r.titulo, r.inicio) for r in once.collect())


def test_weekly_series(spark):
    rows = [{"titulo": "Nado Lu 06:00 h.", "inicio": day(d, 6)} for d in (3, 10, 17)] + [{"titulo": "Obra", "inicio": day(d, 20)} for d in (3, 4)]
    pub = candidates(spark, rows).withColumn("lugar", F.col("lugar_nombre"))
    got = {(r.titulo, r.sesiones, tuple(r.dias_semana or [])) for r in collapse.collapse_weekly_series(pub).collect()}
    assert got == {("Nado", 3, (0,)), ("Obra", None, ())}


def test_upsert_rules(spark):
    empty = spark.createDataFrame([], STORE)
    first = store.upsert_events(empty, candidates(spark, [{"inicio": day(20), "lat": -33.4, "lon": -70.6}]), NOW).drop("resultado")
    first = first.withColumn("estado", F.lit("publicado"))
    batch = candidates(spark, [{"inicio": day(20, 5), "fuente_url": "https://x.cl/2"}, {"inicio": day(20, 6), "fuente_url": "https://x.cl/3"}])
    out = store.upsert_events(first, batch, NOW).collect()
    assert [(r.lat, r.estado, r.fuente_url, r.inicio.hour, r.resultado) for r in out] == [(-33.4, "publicado", "https://x.cl/3", 6, "actualizado")]
    undated = store.upsert_events(empty, candidates(spark, [{"inicio": None}]), NOW).first()
    assert undated.estado == "revisar_fecha"


def test_upsert_is_idempotent(spark, sf):
    c = inputs.candidates(spark, sf)
    once = store.upsert_events(spark.createDataFrame([], STORE), c, NOW).drop("resultado")
    twice = store.upsert_events(once, c, NOW)
    assert twice.filter("resultado <> 'actualizado'").count() == 0
    keep = [n for n in names(STORE)]
    assert once.select(*keep).exceptAll(twice.select(*keep)).count() == 0


def test_life_cycle_keeps_state(spark):
    rows = store.upsert_events(spark.createDataFrame([], STORE), candidates(spark, [{"inicio": day(1)}]), NOW).drop("resultado")
    rows = rows.withColumn("estado", F.lit("descartado"))
    gone = store.expire_past(rows, AS_OF)
    assert gone.first().estado == "caducado"
    back = store.revive_current(gone.withColumn("fin", F.lit("2026-09-01").cast("timestamp_ntz")), AS_OF)
    assert back.first().estado == "descartado"


def test_snapshot_round_trip(spark, sf, tmp_path):
    rows = inputs.store_rows(spark, sf)
    store.write_snapshot(rows, str(tmp_path / "s"))
    back = store.restore_snapshot(spark, str(tmp_path / "s"), None)
    assert back.exceptAll(rows.select(*back.columns)).count() == 0 and back.count() == rows.count()
    same = store.restore_snapshot(spark, str(tmp_path / "s"), rows)
    assert same is rows
    part = rows.filter("lat is not null")
    assert store.restore_snapshot(spark, str(tmp_path / "s"), part).count() == rows.count()


def test_top_k_under_skew(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
                                  (F.col("id") * 7919 % 3001).alias("v"), F.col("id"))
    want = {}
    for r in df.collect():
        want.setdefault(r.k, []).append(r.v)
    for k in (5, F.lit(5) + F.lit(0)):
        got = {}
        for r in skew.top_k(df, ["k"], [F.col("v")], k).collect():
            got.setdefault(r.k, []).append(r.v)
        assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x)[:5] for k, x in want.items()}


def test_lookup_equals_plain_join(spark):
    big = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"))
    dim = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    assert skew.lookup(big, dim, ["k"]).select("id", "k", "d").exceptAll(big.join(dim, "k", "left").select("id", "k", "d")).count() == 0


def test_failure_streaks_brute_force(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for h in range(12):
        t, run, best = datetime(2026, 8, 1), 0, 0
        for s in range(rng.randint(1, 120)):
            t += timedelta(minutes=rng.choice([1, 20, 90, 300]))
            ok = rng.random() < rng.choice([0.2, 0.5])
            run = 0 if ok else run + 1
            best = max(best, run)
            rows.append((f"h{h}", t, len(rows), ok))
        if best >= 3:
            want[f"h{h}"] = best
    df = spark.createDataFrame(rows, "host string, ts timestamp_ntz, seq int, ok boolean")
    assert {r.host: r.racha for r in review.failure_streaks(df).collect()} == want


@pytest.mark.parametrize("variety", [True, False])
def test_rank_diverse_brute_force(spark, variety):
    rng = random.Random(11)
    rows = [("p" + str(i % 2), i, i, float(rng.randint(1, 40)), f"s{rng.randint(0, 8)}" if rng.random() > .3 else "s0", f"t{rng.randint(0, 15)}", f"c{rng.randint(0, 4)}")
            for i in range(300)]
    df = spark.createDataFrame(rows, "perfil string, seq long, id long, puntaje double, fuente string, titulo_base string, categoria string").withColumns(
        {"variedad": F.lit(variety), "lugar": F.lit("")})
    want = set()
    for p in ("p0", "p1"):
        used = set()
        for r in sorted((r for r in rows if r[0] == p), key=lambda r: (-r[3], r[1])):
            keys = {("s", r[4]), ("t", r[5])} | ({("c", r[6])} if variety else set())
            if not keys & used:
                used |= keys
                want.add(r[1])
    got = {r.seq for r in recommend.rank_diverse(df).filter("elegido").collect()}
    assert got == want


def test_demoted_items_take_no_key(spark):
    rows = [("p", 1, 1, 9.0, "A", "x", "c"), ("p", 2, 2, 8.0, "A", "y", "c"), ("p", 3, 3, 7.0, "B", "y", "c")]
    df = spark.createDataFrame(rows, "perfil string, seq long, id long, puntaje double, fuente string, titulo_base string, categoria string").withColumns(
        {"variedad": F.lit(False), "lugar": F.lit("")})
    assert sorted(r.seq for r in recommend.rank_diverse(df).filter("elegido").collect()) == [1, 3]


def test_contained_keys_brute_force(spark):
    rng = random.Random(5)
    names_ = ["".join(rng.choice("ab c") for _ in range(rng.randint(1, 14))).strip() or "a" for _ in range(60)]
    keys = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(25)})
    rng.shuffle(keys)
    got = {r.k: r.clave for r in corrections.contained_key_matches(
        spark.createDataFrame([(n,) for n in set(names_)], "k string"),
        spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "clave string, file_order int")).collect()}
    want = {}
    for n in set(names_):
        hit = n if n in keys else next((k for k in keys if k in n), None)
        if hit:
            want[n] = hit
    assert got == want


def test_lending_needs_the_exact_name(spark):
    rows = [(1, "A", "Sushi Home", "Calle 1", "Ñuñoa"), (2, "B", "Sushi Home Ñuñoa", "", ""), (3, "B", "SUSHI  home", "", "")]
    df = conform(spark.createDataFrame(rows, "seq long, banco string, comercio string, direccion string, comuna string"),
                 "seq bigint, banco string, comercio string, direccion string, comuna string, lat double, lon double, direccion_prestada_de string")
    got = {r.seq: (r.direccion, r.direccion_prestada_de) for r in offers.lend_addresses(df).collect()}
    assert got[2][0] == "" and got[3] == ("Calle 1", "A")


def test_merchant_correction_respects_the_bank(spark):
    rows = [(1, "x", "Holy Moly", "Merced 1", "Santiago"), (2, "x", "Holy Moly", "", "")]
    df = conform(spark.createDataFrame(rows, "seq long, banco_id string, comercio string, direccion string, comuna string"),
                 "seq bigint, banco_id string, comercio string, direccion string, comuna string, cocina string, categoria string, lat double, lon double, precision string, sitio_web string, condiciones string")
    fixes = spark.createDataFrame([("holy moly", "bar", "Hernando 2", "Providencia", "-33,42", "-70.6")], "clave string, cocina string, direccion string, comuna string, lat string, lon string")
    got = {r.seq: r for r in corrections.overlay_merchant_corrections(df, fixes).collect()}
    assert (got[1].direccion, got[1].cocina, got[1].lat) == ("Merced 1", "bar", None)
    assert (got[2].direccion, got[2].comuna, got[2].precision) == ("Hernando 2", "Providencia", "correccion")


def test_shared_pins(spark):
    df = spark.createDataFrame([(1, "a", -33.40001, -70.6, "fuente"), (2, "b", -33.40002, -70.6, "fuente"), (3, "c", -33.5, -70.6, "fuente")],
                               "seq long, lugar string, lat double, lon double, precision string")
    assert {r.seq: r.precision for r in collapse.degrade_shared_pins(df).collect()} == {1: "comuna", 2: "comuna", 3: "fuente"}


def test_gate_blocks(spark, sf):
    pub = inputs.published(spark, sf).withColumns({"escala": F.lit(""), "url": F.lit("https://x.cl")})
    assert quality.publishable(quality.check_events(pub)).first().publicable
    assert not quality.publishable(quality.check_events(pub.unionByName(pub.limit(1)))).first().publicable


def test_publish_splits_exactly(spark, sf):
    rows = store.split_formats(inputs.published(spark, sf).withColumn("dias_semana", F.lit(None).cast("array<int>")))
    n = {r.formato: r["count"] for r in rows.groupBy("formato").count().collect()}
    assert set(n) == {"taller", "panorama"} and sum(n.values()) == rows.count()


def test_state_survives_expiry_upsert_and_revival(spark, sf):
    from kermesse.bindings import inputs
    from kermesse.operators import store as st
    rows = inputs.store_rows(spark, sf).limit(40)
    states = ["borrador", "publicado", "descartado", "revisar_fecha", "caducado"]
    rows = rows.withColumn("estado", F.element_at(F.array(*[F.lit(x) for x in states]), F.pmod(F.xxhash64("hash_dedup"), F.lit(5)).cast("int") + 1)).cache()
    ended = st.expire_past(rows, F.lit("2030-01-01").cast("date"))
    again = st.upsert_events(ended, inputs.candidates(spark, sf).limit(0), inputs.now()).drop("resultado")
    back = st.revive_current(again, F.lit("2000-01-01").cast("date"))
    want = {r.hash_dedup: "borrador" if r.estado == "caducado" else r.estado for r in rows.collect()}
    assert {r.hash_dedup: r.estado for r in back.collect()} == want
    assert back.filter("estado_previo is not null").count() == 0


def test_reconcile_needs_address_title_and_place(spark):
    from kermesse.operators import store as st
    rows = [(1, "u", "Feria", "Plaza", "2024-01-01 10:00:00", "borrador"), (2, "u", "feria", "plaza", None, "revisar_fecha"),
            (3, "", "Feria", "Plaza", None, "revisar_fecha"), (4, "u", "Otra", "Plaza", None, "revisar_fecha"), (5, None, "x", None, None, "revisar_fecha")]
    df = spark.createDataFrame(rows, "id int, fuente_url string, titulo string, lugar_nombre string, inicio string, estado string")
    assert {r.id for r in st.reconcile_dated(df).collect()} == {1, 3, 4, 5}


def test_address_with_many_numbers_resolves(spark):
    from kermesse.functions.places import address_candidates
    r = spark.range(1).select(address_candidates(F.lit("Avenida Macul 100 local 1 piso 2 torre 3 sector 4 block 5, a, b, c, Calle 9")).alias("c")).first()
    assert ("macul", 100) in {(x.street, x.number) for x in r.c} or any(x.number == 100 for x in r.c)


def test_session_range_over_three_years(spark):
    from kermesse.functions.dates import session_range
    r = spark.range(1).select(session_range(F.array(*[F.lit(i) for i in range(7)]), F.lit("2024-01-01"), F.lit("2026-12-31"), F.lit("20:00")).alias("s")).first()
    assert (str(r.s.first), str(r.s.last)) == ("2024-01-01 20:00:00", "2026-12-31 20:00:00")


def test_order_numbers_do_not_meet(spark):
    from kermesse.sources.captures import nested, order_number
    a, b = spark.range(1).select(order_number(F.lit(7), nested(F.lit(0), F.lit(1000))), order_number(F.lit(7), nested(F.lit(1), F.lit(0)))).first()
    assert a < b


def test_ten_thousand_profiles(spark, sf):
    """Profiles are rows: a hundred copies of every question get what one of each gets."""
    from kermesse.bindings import inputs as i
    from kermesse.bindings.ranking import _prepared
    from kermesse.operators import recommend
    rows = _prepared(spark, sf).filter("seq % 10 < 3")
    one = spark.range(100).selectExpr(
        "cast(id as string) perfil", "array('solo', 'pareja', 'amigos', 'ninos', 'nadie')[id % 5] compania",
        "array('panorama', 'musica', 'mover', 'barrio', 'noche')[id % 4] situacion", "array('', 'seguro', 'fuerte', 'taller', 'pasear', 'otra')[id % 6] respuesta",
        "id % 9 = 0 solo_gratis", "case when id % 7 = 0 then 20000 end tope", "case when id % 11 = 0 then 'oriente' else 'todo' end sector")
    many = one.crossJoin(spark.range(100).withColumnRenamed("id", "n")).withColumn("perfil", F.concat_ws("-", "perfil", "n"))
    count = lambda q: {r.perfil: (r.n, round(r.total, 6)) for r in recommend.score_pairs(rows, recommend.profile_table(q), i.now()).groupBy(
        F.substring_index("perfil", "-", 1).alias("perfil")).agg(F.count(F.lit(1)).alias("n"), F.sum("puntaje").alias("total")).collect()}
    assert many.count() == 10_000
    single, copied = count(one), count(many)
    assert len(single) > 40 and copied.keys() == single.keys()
    assert all(copied[k][0] == 100 * n and abs(copied[k][1] - 100 * t) < 1e-3 for k, (n, t) in single.items())


def test_rules_of_a_profile():
    from kermesse.operators.recommend import _rule
    r = dict(zip("compania situacion respuesta pesos base variedad exige_ninos evita_ninos solo_adultos evita categoria_segura sin_charlas sin_recurrentes "
                 "puntos_recurrente puntos_gratis techo senal puntos_senal puntos_ninos desde hasta".split(), _rule("amigos", "musica", "fuerte")))
    assert r["pesos"] == {"musica": 23.0, "fiesta": 18.0} and r["base"] is None and (r["desde"], r["hasta"]) == (19, 3)
    assert r["evita_ninos"] and r["sin_recurrentes"] and r["puntos_recurrente"] == -5.0 and (r["senal"], r["puntos_senal"]) == ("group", 4.0)
    assert _rule("", "mover", "taller")[12] is False and _rule("ninos", "barrio", "")[18] == 0.0


def test_run_log_reads_and_drops_days(spark, tmp_path):
    from kermesse.operators import review
    path = str(tmp_path / "log")
    runs = spark.sql("""select timestamp_ntz'2024-01-01 08:00:00' + make_interval(0, 0, 0, cast(id % 5 as int), cast(id % 3 as int), 0, 0) momento,
        concat('f', id % 4) fuente, cast(id as int) encontrados from range(60)""")
    log = review.append_run_log(runs, path)
    latest = review.latest_run_per_source(log, F.lit("2024-01-03"))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dia" in plan and "(dia" in plan.split("PartitionFilters: ")[1].split("]")[0]
    want = {}
    for r in runs.collect():
        if r.momento.day == 3:
            want[r.fuente] = max(want.get(r.fuente, r.momento), r.momento)
    assert {r.fuente: r.momento for r in latest.collect()} == want
    assert review.expire_run_log(spark, path, "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert {r.dia.day for r in review.read_run_log(spark, path, runs.schema).select("dia").distinct().collect()} == {3, 4, 5}


def test_catalogue_versions_swap_whole(spark, sf, tmp_path):
    from kermesse.bindings import inputs as i
    from kermesse.operators import store as st
    path = str(tmp_path / "catalogo")
    rows = i.published(spark, sf).withColumn("formato", F.when(F.col("seq") % 2 == 0, "taller").otherwise("panorama"))
    first = st.publish_catalogue(rows.filter("seq < 100"), i.now(), path)
    second = st.publish_catalogue(rows, i.now(), path)
    header, back, facets = st.read_published(spark, path)
    head = header.first()
    assert (head.version, head.numero, head.total) == (second, 2, rows.count()) and first != second
    assert sorted(r.seq for r in back.select("seq").collect()) == sorted(r.seq for r in rows.select("seq").collect())
    assert {(r.faceta, r.valor): r.n for r in facets.collect()}["publico", "ninos"] == rows.filter("publico = 'ninos'").count()
    plan = back.filter("formato = 'taller'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(formato" in plan
    # A version that was not finished has no header and is not seen.
    rows.limit(1).write.parquet(f"{path}/unfinished/filas")
    assert st.read_published(spark, path)[0].first().version == second


def test_facets_count_lists_and_leave_blanks_out(spark):
    from kermesse.operators.store import facet_table
    rows = spark.createDataFrame([("a", ["x", "y"]), ("", ["x"]), (None, None)], "f string, d array<string>")
    assert {(r.faceta, r.valor): r.n for r in facet_table(rows, ("f", "d")).collect()} == {("f", "a"): 1, ("d", "x"): 2, ("d", "y"): 1}
