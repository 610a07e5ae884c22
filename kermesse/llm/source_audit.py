"""How far the sources of a language diverge in their words: sparse term counts, group sums and exact divergences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kermesse.llm.common import bounded, python_ready, slices, staged

#: Documents of a language that hold a kept term, and the ranks of a group's terms that are told.
MIN_DOCS, TOP_TERMS = 10, 10
#: The vocabulary is never cut: its greatest size is the greatest integer.
VOCABULARY = 2 ** 31 - 1
#: Terms of a language that one vectoriser keeps at most, by proof (each is in `min_docs` documents) or by a count of the
#: distinct ones; more are dealt out to several vectorisers by hash, and each learns its share whole.
SHARD_TERMS = 9_000_000
#: Cells of document vectors that a task sums at once.
CELLS = 4_000_000
#: Terms whose names are broadcast to name indices; more are joined by a shuffle.
BROADCAST_TERMS = 200_000
#: Rows (group, term) that meet in a task when pairs of groups are evaluated.
BLOCK_ROWS = 200_000
#: Proportions are whole numbers of this many parts.
PARTS = 1_000_000_000
#: Fixed value: the ASCII signs that no term holds.
BREAKS = "".join(map(chr, (*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))))
#: Folders that texts are written to by their language's hash, so that a language is read alone.
FOLDERS = 64


def cleaned(docs: DataFrame) -> DataFrame:
    """`docs` (lang, source, text, folder) with `clean`, the text with a blank for every sign that no term holds and A-Z in
    lower case, and `n`, how many terms blanks part it into."""
    table = np.arange(256, dtype=np.uint8)
    table[[ord(c) for c in BREAKS]] = 32
    table[65:91] += 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 8):
            text = b.column("text").cast(pa.large_string())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            raw = text.buffers()[2]
            data = table[np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]]] if raw is not None else np.zeros(0, np.uint8)
            offsets = offsets - offsets[0]
            begins = data != 32
            inside = begins.copy()
            begins[1:] &= ~inside[:-1]
            edges = offsets[:-1][offsets[:-1] < len(data)]
            begins[edges] = inside[edges]
            n = np.diff(np.searchsorted(np.flatnonzero(begins), offsets))
            clean = pa.Array.from_buffers(pa.large_string(), len(text), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("source"), clean, pa.array(n, pa.int64()), b.column("folder")],
                                             ["lang", "source", "clean", "n", "folder"])

    return docs.select("lang", "source", "text", "folder").mapInArrow(run, "lang string, source string, clean string, n long, folder int")


def terms(clean: Column) -> Column:
    """Terms of a cleaned text, with an empty one wherever blanks meet."""
    return F.split(clean, " ")


def group_sums(vectors: DataFrame) -> DataFrame:
    """Rows (source, at, n): the sum of sparse vectors (source, indices, values) by group, added up in tasks first."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        keys, values, waiting = [], [], 0

        def told() -> pa.RecordBatch:
            found, at = np.unique(np.concatenate(keys), return_inverse=True) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            sums = np.bincount(at, np.concatenate(values) if values else None, len(found)).astype(np.int64)
            names = pa.array(list(codes), pa.string())
            keys.clear()
            values.clear()
            return pa.RecordBatch.from_arrays([names.take(pa.array(found >> 32)), pa.array((found & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)],
                                              ["source", "at", "n"])

        for b in batches:
            cells = b.column("indices")
            own = np.array([codes.setdefault(s, len(codes)) for s in b.column("source").to_pylist()], np.int64)
            keys.append(np.repeat(own, cells.value_lengths().to_numpy()) << 32 | cells.flatten().to_numpy())
            values.append(b.column("values").flatten().to_numpy())
            waiting += len(values[-1])
            if waiting > CELLS:
                yield told()
                waiting = 0
        yield told()

    return vectors.mapInArrow(add, "source string, at int, n long").groupBy("source", "at").agg(F.sum("n").alias("n"))


def whole(a: Column, b: Column) -> Column:
    """a / b without its rest, as a long."""
    return F.call_function("div", a, b)


def part_of(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(PARTS * (count + 2) / (total + 2 * size)), exact for any count."""
    wide = "decimal(20,0)"
    return F.lit(1) + whole(F.lit(PARTS).cast("decimal(10,0)") * (count + 2).cast(wide), total.cast(wide) + 2 * size.cast(wide))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / (p + q)); the square of a difference of parts fits a long."""
    return whole((p - q) * (p - q), p + q)


def counted(docs: DataFrame, min_docs: int, shard_terms: int) -> DataFrame:
    """Rows (lang, source, term, id, n): how often each kept term occurs in each group that has it; `id` numbers the kept
    terms of a language.

    A vectoriser a language learns the terms that enough of its documents hold. Its sparse document vectors are summed by
    group, index by index; sums are reduced before the shuffle and no dense vector is built. Languages with fewer than
    `min_docs` documents keep no term and are left out.
    """
    spark = docs.sparkSession
    folder = F.pmod(F.xxhash64("lang"), F.lit(FOLDERS)).cast("int")
    clean = staged(cleaned(docs.withColumn("folder", folder)), "folder")
    langs = (clean.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"), F.first("folder").alias("folder"))
             .where(F.col("docs") >= min_docs).orderBy("lang").collect())
    out = spark.createDataFrame([], "lang string, source string, term string, id long, n long")
    for lang in langs:
        own = clean.where((F.col("folder") == lang.folder) & (F.col("lang") == lang.lang)).select("source", terms(F.col("clean")).alias("terms"))
        most = lang.n // min_docs
        if most > shard_terms:
            most = own.select(F.explode("terms").alias("t")).agg(F.approx_count_distinct("t", 0.02)).first()[0] * 11 // 10
        shards = max(1, -(-most // shard_terms))
        # A vectoriser wants one term at least: the empty one, which is none.
        none = spark.range(min_docs).select(F.lit("").alias("source"), F.array(F.lit("")).alias("terms"))
        for k in range(shards):
            part = own if shards == 1 else own.withColumn("terms", F.filter("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(shards)) == k))
            model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=VOCABULARY).fit(part.unionByName(none))
            vector = F.unwrap_udt("vector")
            sums = group_sums(model.transform(part).select("source", vector["indices"].alias("indices"), vector["values"].alias("values")))
            words = pa.array(model.vocabulary)
            names = spark.createDataFrame(pa.table({"at": pa.array(range(len(words)), pa.int32()), "term": words})).where("term <> ''")
            named = sums.join(bounded(names, BROADCAST_TERMS), "at").select(
                F.lit(lang.lang).alias("lang"), "source", "term", (F.col("at").cast("long") * shards + k).alias("id"), "n")
            out = out.unionByName(staged(named))
    return out


def pair_sums(cells: DataFrame) -> DataFrame:
    """Rows (lang, a, b, value): for two groups (numbers a < b) of a language, what the terms that both hold add to or
    take from the sums over each one's own terms.

    `cells` (lang, block, id, g, p, z) are groups' proportions `p` of terms, `z` that of a term the group lacks.
    """
    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // (p + q)

    def evaluate(key: tuple, t: pa.Table) -> pa.Table:
        term, g, p, z = (t.column(c).to_numpy() for c in ("id", "g", "p", "z"))
        order = np.lexsort((g, term))
        term, g, p, z = term[order], g[order], p[order], z[order]
        found, step = [], 1
        while len(i := np.flatnonzero(term[step:] == term[:-step])):  # neighbours at each distance in a term's run of groups
            j = i + step
            pairs, at = np.unique(g[i] << 31 | g[j], return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, at, f(p[i], p[j]) - f(p[i], z[j]) - f(z[i], p[j]) + f(z[i], z[j]))
            found.append((pairs, sums))
            step += 1
        pairs, sums = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in found)]) for k in (0, 1))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(pairs), pa.string()), "a": pairs >> 31,
                         "b": pairs & ((1 << 31) - 1), "value": sums})

    return (cells.groupBy("lang", "block").applyInArrow(evaluate, "lang string, a long, b long, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, shard_terms: int = SHARD_TERMS,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every (lang, source) of `docs`.

    Part `pair`: each other source of the language, with the divergence of the two summed over all kept terms. Part
    `term`: the `top_terms` terms that the source uses most beyond its language. Kept are the terms of a language that
    at least `min_docs` of its documents hold. A proportion is p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N the
    group's count of kept terms and V how many are kept; a divergence is floor((p - q)^2 / (p + q)). All arithmetic is
    exact. Ranks start at 1, by value, then by the item's bytes.

    Pairs are evaluated sparsely. A term that neither group holds adds the same to every such term, a term that one
    holds adds what its count alone tells, so each group's counts are summed as a histogram; only terms that both hold
    meet, in blocks of terms of bounded size.

    Null lang, source and text are empty ones. Texts without terms make their group appear with counts of 0; a language
    without kept terms has divergences of 0 and no terms. Repeated rows count as often as they occur. A language of one
    source has no pairs. No rows give no rows. Other columns are ignored. `min_docs` is at least 1.
    """
    python_ready(docs.sparkSession)
    empty = F.lit("")
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")))
    counts = counted(docs, min_docs, shard_terms)
    # Every group that occurs, numbered inside its language, with its total and its language's number of kept terms.
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"))
    by_lang = staged(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("of_lang").alias("lang_total")))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (docs.groupBy("lang", "source").agg(F.lit(1).alias("_one")).drop("_one").join(totals, ["lang", "source"], "left")
              .join(by_lang, "lang", "left"))
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"),
                           F.coalesce("lang_total", zero).alias("lang_total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    groups = staged(groups.withColumns({"g": number.cast("long"), "z": F.when(F.col("v") > 0, part_of(zero, F.col("total"), F.col("v")))}))
    cells = counts.join(bounded(groups, BROADCAST_TERMS), ["lang", "source"]).withColumn("p", part_of(F.col("n"), F.col("total"), F.col("v")))
    cells = staged(cells.select("lang", "source", "term", "id", "g", "n", "p", "z", "v", "lang_total"))

    # Terms of a group beyond its language.
    beyond = cells.join(kept, ["lang", "term"]).withColumn("q", part_of(F.col("of_lang"), F.col("lang_total"), F.col("v"))).where("p > q")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    told = (beyond.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms))

    # What each group's own terms add against another group that lacks them all: its counts as a histogram.
    histogram = staged(cells.groupBy("lang", "g", "p").agg(F.count(F.lit(1)).alias("k")))
    held = cells.groupBy("lang", "g").agg(F.count(F.lit(1)).alias("held"))
    own = staged(groups.join(held, ["lang", "g"], "left").select("lang", "source", "g", "z", "v", F.coalesce("held", zero).alias("held")))
    other = bounded(own.select("lang", F.col("g").alias("b"), F.col("source").alias("item"), F.col("z").alias("zb"), F.col("held").alias("held_b")),
                    BROADCAST_TERMS)
    sided = (histogram.join(other, "lang").where("g <> b")
             .groupBy("lang", F.col("g").alias("a"), "b").agg(F.sum(F.col("k") * divergence(F.col("p"), F.col("zb"))).alias("side")))
    size = staged(cells.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_rows)).cast("int").alias("blocks")))
    blocks = cells.join(bounded(size, BROADCAST_TERMS), "lang").select("lang", F.pmod("id", "blocks").cast("int").alias("block"), "id", "g", "p", "z")
    both = staged(pair_sums(blocks))
    sided = staged(sided)
    pairs = own.withColumnRenamed("g", "a").join(other, "lang").where("a <> b")
    mirrored = both.unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    turned = sided.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("side").alias("other_side"))
    value = (pairs.join(sided, ["lang", "a", "b"], "left").join(turned, ["lang", "a", "b"], "left")
             .join(mirrored, ["lang", "a", "b"], "left")
             .withColumn("value", F.coalesce("side", zero) + F.coalesce("other_side", zero) + F.coalesce("value", zero)
                         + F.coalesce((F.col("v") - F.col("held") - F.col("held_b")) * divergence(F.col("z"), F.col("zb")), zero)))
    ranks = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    met = value.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(ranks))
    return met.unionByName(told)
