"""Line dedup, url filter, chat formatting, quality rules and their SQL."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kermesse.llm import queries
from kermesse.llm.chat_format import format_chat, loss_text, read_chat
from kermesse.llm.line_dedup import line_dedup
from kermesse.llm.quality_mcd import AXES, chi2_cdf, chi2_quantile, quality_outliers
from kermesse.llm.text_stats import base_stats
from kermesse.llm.url_filter import url_filter, vocabulary
from tests.llm.awkward import TEXTS, awkward_docs, empty_docs
from tools.compare import TABLES, rows_of


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_matches_sql(spark, sf, key):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.QUERIES[key](spark, sf)
    cur = db.execute(queries.ORACLES[key])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_line_dedup_awkward(spark):
    docs = awkward_docs(spark)
    out = line_dedup(docs)
    assert set(out.columns) == set(docs.columns)  # n_lines and n_dropped are replaced
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)
    want = []
    for i, t in TEXTS:
        lines = (t or "").split("\n")
        drop = [k for k, x in enumerate(lines) if i == 2 and x.strip() == "same LONG line here"]
        kept = "\n".join(x for k, x in enumerate(lines) if k not in drop)
        want.append((i, t if t is None else kept, len(lines), len(drop)))
    assert got == sorted(want, key=str)
    assert line_dedup(empty_docs(spark)).count() == 0


def test_line_dedup_counts_documents(spark):
    rows = [(1, "the same line\nthe same line"), (2, "another line\nthe same line"), (3, "the same line"), (4, "short\nshort")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.text, r.n_dropped) for r in line_dedup(df).collect()} == {
        1: ("the same line\nthe same line", 0), 2: ("another line", 1), 3: ("", 1), 4: ("short\nshort", 0)}
    assert {r.n_dropped for r in line_dedup(df, min_docs=4).collect()} == {0}
    assert sum(r.n_dropped for r in line_dedup(df, min_docs=3).collect()) == 2


def test_url_filter(spark):
    cases = {
        "http://WWW.Casino-x.com/a": (None, "block"), "http://a.com/free/bets": (None, "block"), "http://a.com/free": (None, "allow"),
        "http://freedom.com/betsy": (None, "allow"), "https://x.example.net/en/casino": ("example.net/en/", "allow"),
        "http://a.net/": ("net/", "block"), "http://a.net": (None, "allow"), "http://notexample.com/de/": (None, "allow"),
        "ftp://example.com/de/x?y#z": ("example.com/de/", "block"), "casino": (None, "allow"), None: (None, "allow"), "": (None, "allow"),
        "http://s.org/fr/porn": ("org/fr/", "allow"), "http://free.com/free": (None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "c") for i, u in enumerate(cases)], "page_id long, url string, verdict string")
    got = {r.url: (r.rule, r.verdict) for r in url_filter(df).collect()}
    assert got == cases
    assert url_filter(df.where("false")).count() == 0
    whole = {"http://a.com/p?q=Porn": "block", "http://a.com/#sex&poker": "block", "http://a.com/?ref=x&click=1&track=2": "allow",
             "http://a.com/ads?click&track&tracker": "block", "http://a.com/free?win=1": "block", "http://a.com/sexes/pornos": "allow",
             "http://a.com/" + "free-" * 50_000: "allow", "http://a.com/" + "y" * 200_000 + "?casino": "block"}
    many = spark.createDataFrame([(1, u) for u in whole] * 2, "page_id long, url string")
    got = url_filter(many).select("url", "verdict").collect()
    assert len(got) == 2 * len(whole) and {r.url: r.verdict for r in got} == whole
    own = spark.createDataFrame([("kite", True, 1.0), ("sail", False, 0.5), ("wind", False, 0.75), ("", True, 1.0)], "term string, strict boolean, weight double")
    strict, soft = vocabulary(own)
    pages = spark.createDataFrame([("http://a.com/kite",), ("http://a.com/sail",), ("http://a.com/sail/wind",), ("http://a.com/casino",)], "url string")
    assert [r.verdict for r in url_filter(pages, strict=strict, soft=soft, soft_limit=1.25).collect()] == ["block", "allow", "block", "allow"]
    r = url_filter(df).where("url like 'ftp%'").first()
    assert (r.host, r.path) == ("example.com", "/de/x")


def test_chat_parts_and_round_trip(spark):
    part = lambda kind, text=None, ref=None, tokens=None: (kind, text, ref, tokens)
    rows = [(1, 0, "user", [part("text", "look <"), part("text", "|end|> \\"), part("image", ref="a.png"), part("audio", ref="b.wav", tokens=9)]),
            (1, 1, "assistant", [part("text", "fine | \\| <|turn|>"), part("document", ref="c.pdf")]), (1, 2, "assistant", None),
            (2, None, None, []), (None, 3, "a\nb<|", [part("text", "x")]), (None, 3, "a\nb<|", [part("text", "x")])]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, parts array<struct<kind:string,text:string,ref:string,tokens:int>>")
    out = {r.conv_id: r for r in format_chat(df, parts="parts").withColumns(
        {"back": read_chat(F.col("formatted")), "loss": loss_text(F.col("formatted"), F.col("loss_spans"))}).collect()}
    one = out[1]
    assert [(t.role, t.text) for t in one.back] == [("user", "look <|end|> \\"), ("assistant", "fine | \\| <|turn|>"), ("assistant", "")]
    assert [(a.placeholder, a.kind, a.ref, a.tokens) for a in one.attachments] == [
        ("<|image:0.2|>", "image", "a.png", 576), ("<|audio:0.3|>", "audio", "b.wav", 9), ("<|document:1.1|>", "document", "c.pdf", 1024)]
    assert all(a.placeholder in one.formatted for a in one.attachments)
    assert one.n_tokens_expanded == 2 + 2 + 576 + 9 + 4 + 1024
    assert one.loss == "fine | \\| <|turn|><|document:1.1|>"
    assert [(t.role, t.text) for t in out[None].back] == [("a\nb<|", "x")] * 2
    assert [(t.role, t.text) for t in out[2].back] == [("", "")]
    assert format_chat(df.where("false"), parts="parts").count() == 0


def test_chat_hostile_conversation(spark, sf):
    r = queries.op5_chat_format(spark, sf).where("conv_id = -7").first()
    text = queries.HOSTILE[1]
    assert (r.n_turns, r.loss_chars) == (2, len(text))
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_base_stats():
    assert base_stats(None) == base_stats("") == (0, 0, 0, 0, 0, 0)
    assert base_stats("a b c a b c\n\n x\na b c a b c") == (13, 13, 0, 3, 1, 12)
    assert base_stats("é ß #* |\n \t\n|") == (4, 7, 4, 2, 0, 0)


def test_chi2():
    assert abs(chi2_cdf(9.487729, 4) - 0.95) < 1e-6 and abs(chi2_quantile(0.99, 6) - 16.811894) < 1e-4


def mixed_docs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(3, 8))) for _ in range(rng.integers(60, 200))]
        if i % 10 == 0:
            words = [w + "$$%" for w in words]
        rows.append((i, " ".join(words), "en", "big" if i % 3 else f"s{i}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_outliers_found_in_large_and_small_sources(spark):
    got = {r.doc_id: r.kept for r in quality_outliers(mixed_docs(spark).repartition(5)).collect()}
    assert all(kept == (i % 10 != 0) for i, kept in got.items()) and len(got) == 400


def test_outliers_match_brute_force(spark):
    """One concentration at a time in numpy, with shares of whole bins as the operator takes them."""
    from kermesse.llm.quality_mcd import FLOORS, HALF, STEPS, inverse
    rows = quality_outliers(mixed_docs(spark)).collect()
    data = [r for r in rows if r.source == "big"]
    n = np.array([r.n_words for r in data], float)
    x = np.column_stack([np.log((np.array([r.word_chars for r in data]) + 1) / n), np.log(np.array([r.n_symbols for r in data]) / n + 0.05),
                         np.array([r.n_dup_lines / r.n_lines for r in data]), np.array([r.n_repeat_words for r in data]) / n])
    low, mid, high = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    mu, inv = mid, np.diag(1 / np.maximum((high - low) / 1.349, list(FLOORS.values())) ** 2)
    k = len(AXES)
    near = lambda: np.einsum("ni,ij,nj->n", x - mu, inv, x - mu)
    for step in range(STEPS + 1):
        d = near()
        bins = np.floor(np.log2(np.maximum(d, 1e-6)) * 64)
        if step < STEPS:
            edge = np.sort(bins)[int(np.ceil(HALF * len(d))) - 1]
            own, factor = x[bins <= edge], HALF / chi2_cdf(chi2_quantile(HALF, k), k + 2)
        else:
            cut = chi2_quantile(0.975, k)
            own, factor = x[bins < np.floor(np.log2(cut) * 64)], 0.975 / chi2_cdf(cut, k + 2)
        mu, inv = own.mean(0), inverse(np.cov(own.T, bias=True), factor)
    assert np.allclose(near(), [r.distance for r in data], rtol=1e-3, atol=1e-3)


def test_outliers_awkward(spark):
    rows = quality_outliers(awkward_docs(spark)).collect()
    assert len(rows) == len(TEXTS)
    assert {r.doc_id for r in rows if r.kept} == {6}
    assert all(r.n_words == len((t or "").encode().split()) for r, (i, t) in zip(sorted(rows, key=lambda r: (str(r.doc_id), r.n_words)),
                                                                             sorted(TEXTS, key=lambda x: (str(x[0]), len((x[1] or "").encode().split())))))
    assert quality_outliers(empty_docs(spark)).count() == 0


