"""Passages that repeat across documents stay only in the document with the smallest id: seed, extend, cut."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kermesse.llm.common import bounded, python_ready, slices, staged
from kermesse.llm.hashing import Words, between, words_of

#: Words of the shortest passage that is cut, and of a seed.
WINDOW, SEED = 50, 12
#: Documents whose ids are broadcast to pick texts (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: A stretch's place is kept as start * LENGTHS + length; stretches are shorter than LENGTHS words.
LENGTHS = 1 << 12


def anchors(words: Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of `window` words, and the place of each one's seed: its least hashed run of `seed` words,
    the leftmost of equal ones. So windows of equal words have equal seeds, whatever stands around them."""
    starts = words.fitting(window)
    if not len(starts):
        return starts, starts
    runs = words.runs(seed)
    low = (runs & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(runs), dtype=np.uint64)
    width, wanted = 1, window - seed + 1
    while width < wanted:
        step = min(width, wanted - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    return starts, (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def seeded(words: Words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per seed: its hash, the hash of the stretch that its windows cover, and where that stretch starts and ends."""
    starts, at = anchors(words, window, seed)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    start, end = starts[head], starts[np.append(head[1:], len(starts)) - 1] + window
    sums = words.sums()
    return between(sums, at[head], at[head] + seed), between(sums, start, end), start, end


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def find_seeds(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """Rows (anchor, span, doc, row, place): one a seed, by the winnowing of every whole text."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            words = words_of(b.column("text"))
            anchor, span, start, end = seeded(words, window, seed)
            owner = np.searchsorted(words.first, start, side="right") - 1
            place = (start - words.first[owner]) * LENGTHS + end - start
            yield pa.RecordBatch.from_arrays([signed(anchor), signed(span), b.column("doc").take(pa.array(owner)),
                                              b.column("row").take(pa.array(owner)), pa.array(place)],
                                             ["anchor", "span", "doc", "row", "place"])

    return docs.mapInArrow(find, "anchor long, span long, doc long, row long, place long")


def find_windows(docs: DataFrame, window: int) -> DataFrame:
    """Rows (anchor, h, doc, row, start): every single window of the stretches listed in `spans` (anchor, place)."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            words = words_of(b.column("text"))
            lists = b.column("spans")
            flat, sizes = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
            anchor, place = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            counts = place % LENGTHS - window + 1
            item = np.repeat(np.arange(len(place)), counts)
            start = (place // LENGTHS)[item] + np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)
            flat_start = words.first[owner[item]] + start
            who = pa.array(owner[item])
            yield pa.RecordBatch.from_arrays([pa.array(anchor[item]), signed(between(words.sums(), flat_start, flat_start + window)),
                                              b.column("doc").take(who), b.column("row").take(who), pa.array(start)],
                                             ["anchor", "h", "doc", "row", "start"])

    return docs.mapInArrow(find, "anchor long, h long, doc long, row long, start long")


def picked(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `texts` (doc, ...) whose `doc` is in `ids`; few ids are broadcast, so only these texts are shuffled later."""
    return texts.join(bounded(staged(ids.select("doc").distinct()), BROADCAST_IDS), "doc", "left_semi")


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Rows (doc, row, places): the stretches of each text, as start * LENGTHS + length in words, that repeat.

    A word is inside one if some window of `window` words over it also starts in a document with a smaller id. `row` is the
    hash of the text, which tells rows that repeat a doc_id apart.

    Seeds are winnowed so that each window has exactly one and equal windows have equal ones. Documents meet on seeds
    that several hold, each with the stretch its windows cover. A stretch that an earlier document holds as a whole is
    extended both ways at once. Of the rest only the first document with each distinct stretch counts: it is extended
    one word at a time, each step being one window of the same seed that an earlier document may hold too. So thousands
    of copies or edited copies of a passage make rows in proportion to their words, and no pairs. The stretches
    of a text join into its maximal repeats (`maximal`).
    """
    python_ready(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("row"), text.alias("text"))
    seeds = staged(find_seeds(texts, window, seed))
    # Written out, so that the join after it stands alone and a hot seed's partition can be split.
    shared = staged(seeds.groupBy("anchor").agg(F.min("doc").alias("least"), F.max("doc").alias("last"),
                                          (F.min("span") < F.max("span")).alias("open"))
                    .where("least < last").select("anchor", "open"))
    hits = staged(seeds.join(shared, "anchor"))
    leads = staged(hits.groupBy("anchor", "span").agg(F.min("doc").alias("least"), F.max("doc").alias("last"), F.first("open").alias("open")))
    # Of an open seed the first holders of its stretches differ from one another, unless one document holds them all.
    several = (leads.where("open").groupBy("anchor").agg(F.min("least").alias("a"), F.max("least").alias("z"))
               .where("a < z").select("anchor", F.lit(True).alias("several")))
    leads = staged(leads.join(several, "anchor", "left").where("least < last or several").select("anchor", "span", "least"))
    met = staged(hits.join(leads, ["anchor", "span"]).select("anchor", "doc", "row", "place", "open", (F.col("doc") > F.col("least")).alias("after")))
    whole = met.where("after").select("doc", "row", "place")
    spans = staged(met.where("open and not after").groupBy("doc", "row").agg(F.collect_list(F.struct("anchor", "place")).alias("spans")))
    steps = staged(find_windows(picked(texts, spans).join(spans, ["doc", "row"]).dropDuplicates(["doc", "row"]), window))
    first = staged(steps.groupBy("anchor", "h").agg(F.min("doc").alias("least"), F.max("doc").alias("last")).where("least < last"))
    single = (steps.join(first.select("anchor", "h", "least"), ["anchor", "h"]).where("doc > least")
              .select("doc", "row", (F.col("start") * LENGTHS + window).alias("place")))
    return whole.unionByName(single).groupBy("doc", "row").agg(F.collect_set("place").alias("places"))


def maximal(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of a text's `n` words the stretches cover, and where the maximal repeats that they join into start and end."""
    steps = np.zeros(n + 2, np.int64)
    np.add.at(steps, places // LENGTHS, 1)
    np.add.at(steps, places // LENGTHS + places % LENGTHS, -1)
    inside = np.cumsum(steps[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    return inside[:n], edges[::2], edges[1::2]


def cut(texts: DataFrame) -> DataFrame:
    """`texts` (doc_id, text, places) less the words inside `places`; words are joined by one blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            kept, total, removed, found = [], [], [], []
            for text, places in zip(b.column("text").to_pylist(), b.column("places").to_pylist()):
                words = (text or "").encode().split()
                total.append(len(words))
                found.append([])
                if places:
                    inside, starts, ends = maximal(np.array(places), len(words))
                    found[-1] = [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())]
                    words = list(compress(words, (~inside).tolist()))
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "text", "n_words", "n_removed", "repeats"])

    return texts.mapInArrow(run, "doc_id long, text string, n_words long, n_removed long, repeats array<struct<start: long, end: long>>")


def substring_dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """`doc_id` and `text` less the words that repeat an earlier document, with `n_words` and `n_removed` (long)
    and `repeats`, the maximal repeats that go, as sorted disjoint word intervals [start, end).

    Words are `[^\\x20\\x09-\\x0D]+`, as they are. A word goes if a window of `window` words over it also starts in a
    document with a smaller id; windows are judged on the input. What stays is joined by one blank.

    Null, empty and short texts lose nothing; a null text has no words. Rows that repeat a doc_id are one document, each
    row cut by itself; a passage twice in one document stays. A null doc_id is neither before nor after others: such a
    row holds no passage and loses nothing. No rows give no rows; other columns are ignored. `seed` is at most `window`,
    and `window` under half of LENGTHS.
    """
    assert 0 < seed <= window and 2 * window < LENGTHS
    places = staged(repeats(docs, window, seed))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    found = bounded(staged(places.select(F.col("doc").alias("doc_id")).distinct()), BROADCAST_IDS)
    # Only texts that lose words are shuffled to their places, where the ids are few enough to be told apart without.
    hit = own.join(found, "doc_id", "left_semi").withColumn("row", F.xxhash64("text")).join(
        places.withColumnRenamed("doc", "doc_id"), ["doc_id", "row"], "left").select("doc_id", "text", "places")
    rest = own.join(found, "doc_id", "left_anti").withColumn("places", F.lit(None).cast(hit.schema["places"].dataType))
    return cut(rest.unionByName(hit))
