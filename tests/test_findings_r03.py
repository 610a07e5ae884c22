"""What the third round found."""

import re

import pytest
from pyspark.sql import functions as F

from kermesse.functions import rules
from kermesse.functions.text import WORD_START


@pytest.fixture
def busy(spark, tmp_path):
    """Events of users with numbers beyond those of the smaller tables."""
    spark.sql("""SELECT id AS event_id, timestamp_ntz'2024-01-14 10:20:00' AS ts, array(7L, 1209L, 287L, 288L, 998L, 999L)[id] AS user_id,
      'view' AS event_type, 1.5D AS value, '{"k": 1}' AS props FROM range(6)""").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_shared_beginning_is_tried_once():
    for axis, name in (("publico", "palabra +18"), ("escala", "recinto masivo")):
        layer = rules.layer(None, axis, name)
        assert len(layer) > 4
        assert rules.any_of(r.patron for r in layer).count(WORD_START) == 1


def test_any_of_matches_what_its_patterns_match():
    patterns = [r"\bab(c|d)", r"\bx|y", r"\b[|(]z", r"\bq\|", WORD_START + "(?:uno dos)(?![a-z0-9])", r"\b[]|]w", "k+"]
    one = re.compile(rules.any_of(patterns))
    for t in ("abd", "zabd", "y", "ay", "x", "q|", "q", "a(z", "uno dos", "uno dosx", "auno dos", "k", "", "a|w", "]w"):
        assert bool(one.search(t)) == any(re.search(p, t) for p in patterns), t


def test_audit_labels_rows_alike_once(spark):
    from kermesse.operators.review import rule_audit
    row = "'Concierto' AS titulo, '' AS categoria, 'x' AS descripcion_corta, 'GAM' AS lugar_nombre, 'f' AS fuente_nombre"
    out = rule_audit(spark.range(30).selectExpr("id % 2 AS n", *row.split(", ")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 4
    assert {(r.eje, r.n) for r in out.collect()} == {("categoria", 30), ("subcategoria", 30), ("escala", 30), ("publico", 30)}


def test_seconds_beyond_a_day_start_on_a_later_day(spark, busy):
    from kermesse.bindings.extraction import a05
    got = {r.id: r.inicio for r in a05(spark, busy).filter("id % 2 = 1").collect()}
    assert got == {1: "2024-01-18 04:45", 3: "2024-01-15 00:00", 5: "2024-01-17 11:15"}


def test_cards_with_long_prices_are_left_out(spark, busy):
    from kermesse.bindings.extraction import a07
    assert {(r.id, r.precio) for r in a07(spark, busy).collect()} == {(0, 998), (2, 288), (3, 289), (4, 999)}


def test_house_numbers_as_long_as_the_catalogue_has_them(spark):
    from kermesse.functions.places import address_candidates
    read = lambda n: [tuple(c) for c in spark.range(1).select(address_candidates(F.lit("Av. Macul 123456"), n)).first()[0]]
    assert read(5) == [] and read(9) == [("avenida macul", 123456)]


def test_geocode_finds_long_house_numbers(spark):
    from kermesse.operators import geocode as g
    street = spark.sql("SELECT 'avenida macul' AS calle, 123456 AS numero, '' AS ciudad, -33.45D AS lat, -70.6D AS lon")
    places = spark.sql("SELECT 'bar uno' AS nombre, 'bar' AS tipo, -33.4D AS lat, -70.6D AS lon, '' AS direccion, '' AS ciudad")
    asked = spark.sql("SELECT 'a' AS qid, 'Otro' AS lugar, 'Av. Macul 123456' AS direccion, '' AS comuna")
    cat = g.catalogue_of(street, places, digits=9)
    assert [(r.lat, r.precision) for r in g.geocode_queries(asked, cat).collect()] == [(-33.45, "calle")]
    assert g.strict_addresses(asked, cat.spans, digits=9).count() == 1
    assert g.loose_addresses(asked, cat.spans, digits=9).count() == 1


def test_closed_references_only(spark):
    from kermesse.functions.text import strip_html
    got = lambda **k: spark.range(1).select(strip_html(F.lit("a &amp &hearts; &#x41; &amp;lt; &nope; &ampx;"), every_entity=True, **k)).first()[0]
    assert got() == "a & ♥ A &lt; &nope; &x;"
    assert got(closed=True) == "a &amp ♥ A &lt; &nope; &ampx;"


def test_cards_leave_a_worker_a_few_thousand_at_a_time():
    """A batch of many pages comes out as several, in the order of its pages."""
    import pyarrow as pa

    from kermesse.sources.html import CARDS_AT_ONCE, _card_batches
    pages = ["<body>" + "<div class='evento x'><h3>T</h3> t</div>" * 50 + "</body>"] * 200 + [None]
    batch = pa.RecordBatch.from_pydict({"seq": list(range(201)), "body": pages})
    got = list(_card_batches(iter([batch, batch.slice(0, 1)]), ("div.evento",), {"titulo": "h3"}, "data-date", None))
    assert [b.num_rows for b in got] == [CARDS_AT_ONCE] * 5 + [50]
    rows = [r for b in got for r in b.to_pylist()]
    assert [(r["captura"], r["pos"]) for r in rows[:10_000]] == [(s, p) for s in range(200) for p in range(50)]
    assert {(tuple(r["clases"]), r["titulo"], r["texto"]) for r in rows} == {(("evento", "x"), "T", "T t")}


def test_alignment_does_not_turn_on_the_number_of_children():
    """Siblings left alone at the end change no match before them."""
    from kermesse.llm.wrapper_extract import aligned
    one, two = ([[label, f"{label}{k}", []] for label in labels] for k, labels in enumerate(("pqr", "rpqs")))
    small = aligned(["b", "", one], ["b", "", two])
    wide = aligned(["b", "", [*one, *([f"x{i}", "", []] for i in range(200))]], ["b", "", [*two, *([f"y{i}", "", []] for i in range(200))]])
    assert small == wide == [(0, 0, True), (1, 2, False), (2, 3, False)]


def test_failures_are_counted_over_packed_fetches():
    import numpy as np

    from kermesse.streaming.state import FETCH, count_failures
    rng = np.random.default_rng(5)
    for _ in range(200):
        rows = sorted((int(t), s, bool(ok)) for s, (t, ok) in enumerate(zip(rng.integers(0, 9, 12), rng.integers(0, 3, 12) == 0)))[:rng.integers(0, 13)]
        run, worst, passed = 2, 3, int(rng.integers(0, 10))
        counts = [(run, worst)]
        for _, _, ok in rows:
            run = 0 if ok else run + 1
            worst = max(worst, run)
            counts.append((run, worst))
        done = sum(t <= passed for t, _, _ in rows)
        assert count_failures(np.array(rows, dtype=FETCH), 2, 3, passed) == (counts[done], counts[-1], done)


def test_a_waiting_fetch_takes_few_bytes():
    from kermesse.streaming.state import CHUNK, _packed
    parts = _packed((k, k, k % 3 == 0) for k in range(25_000))
    assert [len(p) for p in parts] == [CHUNK, CHUNK, 5_000] and sum(p.nbytes for p in parts) == 25_000 * 17


def test_f16_exact_matches_read_whole_streets_alone(spark):
    from kermesse.operators import geocode
    rows = spark.createDataFrame([("avenida uno norte", 5, "", -33.4, -70.6)], "calle string, numero int, ciudad string, lat double, lon double")
    places = spark.createDataFrame([], "nombre string, tipo string, lat double, lon double, direccion string, ciudad string")
    cat = geocode.write_catalogue(rows, places)
    assert cat.spans.count() == 6
    for kinds, folders in (("kind = 0", {0}), ("kind > 0", {1, 2, 3})):
        read = cat.spans.filter(kinds)
        assert read.count() == len(folders) + (kinds == "kind > 0") * 2
        assert "PartitionFilters: [isnotnull(kind" in read._jdf.queryExecution().executedPlan().toString()
