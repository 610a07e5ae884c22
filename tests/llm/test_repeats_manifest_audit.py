"""Substring dedup, Merkle manifest and source audit against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kermesse.llm import source_audit as audit
from kermesse.llm import substring_dedup as sub
from kermesse.llm.hashing import words_of
from kermesse.llm.merkle import children, manifest, proofs, ranked
from tests.llm.awkward import TEXTS, awkward_docs, empty_docs

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# -- words -----------------------------------------------------------------------------------

def test_word_hashes_follow_the_words():
    texts = ["a b  c\x0bd", "", None, " A b", "c d a", "é日 本", "a b", " \t", "y" * 3_000_000 + " a b", "A"]
    w = words_of(pa.array(texts))
    words = [x for t in texts for x in WORD.findall((t or "").encode())]
    assert len(words) == len(w.hashes) and w.first.tolist() == np.cumsum([0] + [len(WORD.findall((t or "").encode())) for t in texts]).tolist()
    by_word = collections.defaultdict(set)
    for word, h in zip(words, w.hashes.tolist()):
        by_word[word].add(h)
    assert all(len(h) == 1 for h in by_word.values()) and len({min(h) for h in by_word.values()}) == len(by_word)
    low = words_of(pa.array(texts).slice(3, 2), lower=True)
    assert low.hashes.tolist() == words_of(pa.array([" a b", "c d a"])).hashes.tolist()


# -- repeats ---------------------------------------------------------------------------------

def cut_by_hand(rows, window):
    """(doc_id, text) -> (words, removed, kept) for every row, in order."""
    least = {}
    split = [WORD.findall((t or "").encode()) for _, t in rows]
    for (d, _), w in zip(rows, split):
        for p in range(len(w) - window + 1) if d is not None else ():
            k = tuple(w[p:p + window])
            least[k] = min(least.get(k, d), d)
    out = []
    for (d, _), w in zip(rows, split):
        gone = set()
        for p in range(len(w) - window + 1) if d is not None else ():
            if least[tuple(w[p:p + window])] < d:
                gone.update(range(p, p + window))
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in df.collect()), key=str)


@pytest.mark.parametrize("window, seed", [(6, 3), (5, 5), (12, 4), (9, 1)])
def test_repeats_are_those_of_brute_force(spark, window, seed):
    """Passages, edited copies, repeated phrases and short alphabets, so that seeds meet in unequal stretches."""
    rng = np.random.default_rng(window)
    passages = [[f"p{k}_{i}" for i in range(30)] for k in range(4)]
    rows = []
    for d in range(60):
        words = [str(x) for x in rng.integers(0, 3 if d % 3 == 0 else 500, rng.integers(0, 40))]
        for k in rng.integers(0, 4, rng.integers(0, 3)):
            own = list(passages[k][rng.integers(0, 10):rng.integers(15, 31)])
            if rng.random() < 0.5:
                own[rng.integers(0, len(own))] = f"edit{d}"
            words += own + [f"x{d}"] * int(rng.integers(0, 2))
        rows.append((int(rng.integers(0, 50)), "  ".join(words)))
    assert rows_of(sub.substring_dedup(docs_of(spark, rows), window, seed)) == cut_by_hand(rows, window)


def test_repeats_hot_passage_and_edited_copies(spark):
    """A third of all rows are copies of one text, each with one word changed."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(f"d{i}_{k}" for k in range(60))) for i in range(200, 400)]
    for i in range(100):
        own = list(base)
        own[int(rng.integers(0, 150))] = f"e{i}"
        rows.append((i, " ".join(own)))
    got = sub.substring_dedup(docs_of(spark, rows))
    assert rows_of(got) == cut_by_hand(rows, 50)
    assert {r.doc_id: r.n_removed for r in got.collect()}[0] == 0


def test_repeats_awkward_rows(spark):
    rows = [(i, t) for i, t in TEXTS] + [(20, " ".join(f"w{i % 977}x{i}" for i in range(500, 700)))]
    docs = awkward_docs(spark).select("doc_id", "text").unionByName(docs_of(spark, rows[-1:])).withColumns(
        {c: F.lit("clash") for c in ("row", "places", "n_words", "repeats", "anchor")})
    out = sub.substring_dedup(docs)
    assert rows_of(out) == cut_by_hand(rows, 50)
    assert {tuple(map(tuple, r.repeats)) for r in out.where("doc_id = 20").collect()} == {((0, 200),)}
    assert sub.substring_dedup(empty_docs(spark)).count() == 0


def test_repeats_of_real_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert rows_of(sub.substring_dedup(docs)) == cut_by_hand([tuple(r) for r in docs.collect()], 50)


# -- manifest --------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def tree_by_hand(level):
    """Levels from the leaves to the root."""
    out = [level]
    while len(level) > 1:
        level = [sha(*level[i:i + 3]) for i in range(0, len(level), 3)]
        out.append(level)
    return out


def siblings_by_hand(levels, at):
    out, sides = [], []
    for level in levels[:-1]:
        run = at // 3 * 3
        own = level[run:run + 3]
        sides.append((own[:at - run], own[at - run + 1:]))
        out += own[:at - run] + own[at - run + 1:]
        at //= 3
    return out, sides


def proofs_by_hand(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.source].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[s] = own, tree_by_hand([leaf_of(r, r.text) for r in own])
    top = tree_by_hand([trees[s][1][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        own, levels = trees[s]
        for i, r in enumerate(own):
            a, x = siblings_by_hand(levels, i)
            b, y = siblings_by_hand(top, k)
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            fold = leaf_of(r, text)
            for left, right in x + y:
                fold = sha(*left, fold, *right)
            out.append((r.doc_id, levels[0][i], levels[-1][0], top[-1][0], tuple(a + b), fold, fold == top[-1][0]))
    return sorted(out, key=str)


def told(spark, docs):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    out = proofs(docs, F.coalesce(tampered, F.col("text")))
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple(r.siblings), r.folded_root, r.verified) for r in out.collect()), key=str)


def test_proofs_are_those_of_brute_force(spark):
    """Sources of 1 to 800 rows, among them a hot one, so trees of every depth meet."""
    rows = [(i, f"t\n{i}", None if i % 3 == 0 else "en", s, i) for s, n in (
        (None, 2), ("", 1), ("a", 3), ("b", 4), ("é", 10), ("hot", 800), ("z", 28), ("zz", 81), ("{", 82)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert told(spark, docs) == proofs_by_hand(docs.collect())


def test_proofs_of_awkward_rows(spark):
    docs = awkward_docs(spark).withColumns({c: F.lit("clash") for c in ("grp", "rank", "digest", "path", "height", "children")})
    assert told(spark, docs) == proofs_by_hand(docs.collect())
    assert told(spark, docs.where("doc_id = 7")) == proofs_by_hand(docs.where("doc_id = 7").collect())
    assert proofs(empty_docs(spark)).count() == 0
    assert all(r.verified for r in proofs(docs).collect())


def test_records_are_content_addressed(spark):
    leaves = spark.range(100).selectExpr("cast(id % 2 as string) grp", "floor(id / 2) rank", "sha2(cast(floor(id / 2) as string), 256) digest")
    store = manifest(leaves)["records"]
    assert store.count() == 2 + 1 + 1  # two equal trees are stored once: records of 50 and 2 nodes, and the one over both
    nodes = children(store).collect()
    assert len(nodes) == 17 + 6 + 2 + 1 + 1 and all(r.digest == sha(*r.children) for r in nodes)


def test_ranks_across_partitions(spark):
    rows = spark.range(1000).selectExpr("case when id % 3 = 0 then null else id % 5 end g", "(id * 7919) % 1000 v")
    got = collections.defaultdict(list)
    for r in ranked(rows, "g", ["v"]).collect():
        got[r.g].append((r["rank"], r.v))
    for own in got.values():
        own.sort()
        assert [x[0] for x in own] == list(range(len(own))) and [x[1] for x in own] == sorted(x[1] for x in own)


# -- audit -----------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def audit_by_hand(rows, min_docs=10):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for lang, source, text in rows]
    held = collections.defaultdict(collections.Counter)
    for lang, _, t in docs:
        held[lang].update(set(t))
    kept = {lang: {t for t, n in c.items() if n >= min_docs} for lang, c in held.items()}
    counts, by_lang = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, t in docs:
        own = [x for x in t if x in kept[lang]]
        counts[lang, source].update(own)
        by_lang[lang].update(own)
    part = lambda c, t, v: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * v)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, source in counts:
        own, terms = counts[lang, source], kept[lang]
        v = len(terms)
        pairs = [(o, sum(f(part(own, t, v), part(counts[lang, o], t, v)) for t in terms)) for k, o in counts if k == lang and o != source]
        best = [(t, f(part(own, t, v), part(by_lang[lang], t, v))) for t in terms
                if own[t] and part(own, t, v) > part(by_lang[lang], t, v)]
        for name, items, most in (("pair", pairs, None), ("term", best, 10)):
            items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, name, item, value, k + 1) for k, (item, value) in enumerate(items)]
    return sorted(out)


def audited(df, **options):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in audit.source_divergence(df, **options).collect())


@pytest.mark.parametrize("options", [{}, {"shard_terms": 40, "block_rows": 13}])
def test_divergence_is_that_of_brute_force(spark, options):
    rng = np.random.default_rng(4)
    words = ["alpha", "BETA", "gamma", "é", "日本", "d", "e", "Rare1", "rare2", "x-y", "3d4", "Ünder"]
    rows = []
    for i in range(300):
        source = None if i % 7 == 0 else f"s{rng.integers(0, 5)}" if i % 3 else "hot"
        own = rng.choice(words[:9] if source == "hot" else words, rng.integers(0, 12))
        rows.append((["en", "de", None][i % 3 if i % 2 else 0], source, None if i % 41 == 0 else " ".join(own)))
    rows += [("fr", "only", "one text"), ("it", "a", None), ("it", "b", ""), ("en", "silent", "123 !")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit("x") for c in ("terms", "vector", "n", "g")})
    assert audited(docs, **options) == audit_by_hand(rows)


def test_divergence_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert audited(docs) == audit_by_hand(rows)
    assert audited(docs, min_docs=2) == audit_by_hand(rows, 2)
    assert audited(empty_docs(spark)) == []


def test_parts_are_exact_beyond_longs(spark):
    n, total, v = 9_000_000_000_000, 9_000_000_000_001, 17
    row = spark.range(1).select(audit.part_of(F.lit(n), F.lit(total), F.lit(v)).alias("p"), audit.divergence(F.lit(1_000_000_001).cast("long"), F.lit(1).cast("long")).alias("f")).first()
    assert row.p == 1 + 1_000_000_000 * (n + 2) // (total + 2 * v) and row.f == 1_000_000_000 ** 2 // 1_000_000_002
