"""Benchmark passages found in documents by SimHash windows, Hamming blocks and exact weighted shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kermesse.llm.common import BLANKS, NEAR, SHINGLE_WORDS, ascii_lower, bounded, staged

#: Bits that fingerprints may differ in, and blocks of their 64 bits. Some block differs in RADIUS // BLOCKS bits at most.
RADIUS, BLOCKS, BLOCK_BITS = 19, 5, 13
#: Index rows (three numbers each) that are broadcast; a larger index is joined by a shuffle.
BROADCAST_INDEX = 2_000_000
#: Documents with hits whose numbers are broadcast to pick their texts; more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000


def split_words(text: Column) -> Column:
    """Words between ASCII blanks, A-Z lowered; null and blank: none."""
    clean = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(ascii_lower(clean), "[ \\t-\\r]+"))


def shingle_at(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)])


def shingles(words: Column, size: int) -> Column:
    """Hashes of all shingles of `size` words in order; fewer words: one hash of them all."""
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    many = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: shingle_at(words, i, size))
    return F.when(F.size(words) >= size, many).when(F.size(words) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def numbered(hashes: Column) -> Column:
    """Each hash with the count of its occurrences so far, so that arrays intersect as weighted sets."""
    return F.transform(hashes, lambda x, i: F.struct(x.alias("h"), F.size(F.filter(F.slice(hashes, 1, i + 1), lambda y: y == x)).alias("k")))


def simhash(hashes: Column) -> Column:
    """64 bits: each is the weighted majority of that bit over the shingles."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda bits, b: F.when(
        F.aggregate(hashes, F.lit(0), lambda n, x: n + F.call_function("getbit", x, b).cast("int")) * 2 > F.size(hashes),
        bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))).otherwise(bits))


def block(fingerprint: Column, m: Column) -> Column:
    return F.call_function("shiftrightunsigned", fingerprint, m * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = NEAR, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row a document and benchmark item found in it: `doc_id`, `item_id`, `start` and `n_words` of the best
    window, `shared` and `united` weights of shingles, `similarity` (at least `threshold`).

    Windows have the size of an item (a shorter document is one window). A shared shingle aligns the item at a start;
    all starts from the least to the largest of shingles that one window can hold are fingerprinted. Moving a window
    from outside towards them drops no shared shingle, so no other window is more similar.
    Equal windows are treated once. Fingerprints meet through blocks: an item is written under every block value within
    RADIUS // BLOCKS bits, so all windows of its size within RADIUS bits are found. Candidates are verified by the
    weighted Jaccard similarity of their shingles, a shingle weighing as often as it occurs.

    The index holds positions and sizes, not items, so boilerplate common to many items costs no more; it is
    broadcast if its counted rows are few, else joined by a shuffle. Null and blank texts, items without words and
    rows with a null `doc_id` match nothing; rows that repeat a `doc_id` are one document; repeated items match
    once. Empty tables give no rows; other columns are ignored.
    """
    items = staged(benchmark.select("item_id", split_words(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
                   .withColumn("n", F.size("words")).withColumn("h", shingles(F.col("words"), size)))
    index = staged(items.select("n", F.posexplode("h").alias("at", "h")).distinct())
    kept = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    words = kept.select("doc_id", split_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    found = None
    # Items shorter than a shingle are sought as one shingle of their own size.
    for k in [r[0] for r in index.select(F.least("n", F.lit(size)).alias("k")).distinct().orderBy("k").collect()]:
        own = bounded(index.where(F.least("n", F.lit(size)) == k), BROADCAST_INDEX)
        places = words.where(F.size("words") >= k).select("doc_id", "words", F.size("words").alias("total"),
                                                          F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("p"))
        h = (shingle_at(F.col("words"), F.col("p"), k) if k == size
             else F.xxhash64(F.concat_ws(" ", *[F.get("words", F.col("p") + i) for i in range(k)])))
        hits = places.select("doc_id", "total", "p", h.alias("h")).join(own, "h")
        start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("at"), F.col("total") - F.col("n")))
        hits = hits.select("doc_id", start.alias("start"), "n", "p").groupBy("doc_id", "n", "p").agg(F.min("start").alias("low"), F.max("start").alias("high"))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "doc_id long, n int, p int, low int, high int").withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    # Ranges of neighbouring hits overlap, so together they hold every start between those of any hits of a window.
    in_order = Window.partitionBy("doc_id", "n").orderBy("p")
    ranges = found.withColumns({c: F.when(F.col("p") - F.lag("p").over(in_order) <= F.col("n") - size, F.lag(of).over(in_order))
                                for c, of in (("low_before", "low"), ("high_before", "high"))})
    starts = staged(ranges.select("doc_id", F.explode(F.sequence(F.least("low", "low_before"), F.greatest("high", "high_before"))).alias("start"), "n")
                    .distinct())
    texts = kept.join(bounded(starts, BROADCAST_WINDOWS), "doc_id")
    windows = staged(texts.withColumn("words", split_words(F.col("text"))).select(
        "doc_id", "start", "n", F.slice("words", F.col("start") + 1, F.col("n")).alias("words")).distinct())
    contents = staged(windows.select("n", "words").distinct().withColumn("h", shingles(F.col("words"), size))
                      .where(F.size("h") > 0)
                      .select("n", F.xxhash64("words").alias("w1"), F.xxhash64(F.lit(1), "words").alias("w2"), "h", simhash(F.col("h")).alias("f")))
    marked = staged(items.select("item_id", "n", "h", simhash(F.col("h")).alias("g")))
    near = F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda x: F.bit_count(x) <= RADIUS // BLOCKS)
    every = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    indexed = (marked.select("item_id", "n", "g", F.explode(every).alias("m")).withColumn("mask", F.explode(near))
               .select("item_id", "n", "g", "m", block(F.col("g"), F.col("m")).bitwiseXOR(F.col("mask")).alias("v")))
    probes = contents.select("n", "w1", "w2", "f", F.explode(every).alias("m")).withColumn("v", block(F.col("f"), F.col("m")))
    candidates = (probes.join(indexed, ["n", "m", "v"]).where(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= RADIUS)
                  .select("n", "w1", "w2", "item_id").distinct())
    pairs = (candidates.join(contents.select("n", "w1", "w2", numbered(F.col("h")).alias("x")), ["n", "w1", "w2"])
             .join(marked.select("item_id", "n", numbered(F.col("h")).alias("y")), ["item_id", "n"]))
    shared = F.size(F.array_intersect("x", "y"))
    matched = staged(pairs.withColumn("shared", shared).withColumn("united", F.size("x") + F.size("y") - F.col("shared"))
                     .where(F.col("shared") >= threshold * F.col("united"))
                     .select("n", "w1", "w2", "item_id", "shared", "united"))
    placed = windows.select("doc_id", "start", "n", F.xxhash64("words").alias("w1"), F.xxhash64(F.lit(1), "words").alias("w2")).join(
        matched, ["n", "w1", "w2"])
    similarity = F.col("shared") / F.col("united")
    best = F.max(F.struct(similarity.alias("similarity"), (-F.col("start")).alias("back"), F.col("n").alias("n_words"), "shared", "united"))
    return placed.groupBy("doc_id", "item_id").agg(best.alias("_b")).select(
        "doc_id", "item_id", (-F.col("_b.back")).alias("start"), "_b.n_words", "_b.shared", "_b.united", "_b.similarity")
