"""Documents whose word shingles overlap, joined exactly by prefixes of tokens and token combinations."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kermesse.llm.common import SHINGLE_WORDS, bounded, python_ready, slices, staged
from kermesse.llm.components import components
from kermesse.llm.hashing import between, mixed, words_of

#: Similarity in percent that links two sets.
PERCENT = 75
#: A token counted in so many sets is indexed in combinations of 2, of 3.
FREQUENT = (24, 240)
#: Most frequent tokens kept (8 bytes each); the others count as rare, which changes work and no result.
MOST_FREQUENT = 400_000
#: Combinations are formed inside parts, one for so many tokens; sets of up to twice as many use single tokens.
PART = 8
#: Tokens that a task counts together, and the count there that makes one worth reporting.
CHUNK, REPORTED = 6_000_000, 2
#: Nodes whose numbers are broadcast to pick texts (16 bytes each); more are joined by a shuffle.
BROADCAST_NODES = 1_000_000
#: Words of 64 bits in the bitmap that pairs of a bucket are compared by.
SHORT = 32
#: Bucket keys of a node by which pairs that meet earlier are known.
FIRST = 16


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each whole text, A-Z in lower case; with fewer words, the hash of them all;
    without, none."""
    words = words_of(texts, lower=True)
    runs, first = words.runs(size), words.first
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    short = dict(zip(few.tolist(), between(words.sums(), first[few], first[few + 1]))) if len(few) else {}
    return [np.unique(runs[a:b - size + 1]) if b - a >= size else np.array([short[k]] if k in short else [], np.uint64)
            for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist()))]


def digest(s: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    import xxhash
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def read_sets(docs: DataFrame, size: int) -> DataFrame:
    """One pass over all texts: a row (doc_id, key, node, n) a document, and rows (token, hits) of tokens that are
    frequent in some chunk of a task."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted():
            tokens, hits = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, int))
            many = hits >= REPORTED
            held.clear()
            n = int(many.sum())
            return pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 4,
                                               pa.array(tokens[many].view(np.int64)), pa.array(hits[many].astype(np.int64))], names)

        names, waiting = ["doc_id", "key", "node", "n", "token", "hits"], 0
        for b in slices(batches, 4):
            sets = shingle_sets(b.column("text"), size)
            k = len(sets)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array([digest(s) if len(s) else None for s in sets], pa.int64()),
                                              pa.array([len(s) for s in sets], pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names)
            held += sets
            waiting += sum(map(len, sets))
            if waiting > CHUNK:
                yield counted()
                waiting = 0
        yield counted()

    return docs.mapInArrow(read, "doc_id long, key long, node long, n long, token long, hits long")


class Order:
    """The global order of tokens: class by class, rarer first, then by hash."""

    def __init__(self, tokens: np.ndarray, hits: np.ndarray, limits: list[float]):
        at = np.argsort(tokens)
        self.tokens, self.hits, self.limits = tokens[at], hits[at], limits

    def of(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The set in this order, and each token's class (combinations of class + 1 tokens)."""
        hits = np.zeros(len(s), np.int64)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
            hits = np.where(self.tokens[at] == s, self.hits[at], 0)
        order = np.lexsort((s, hits))
        return s[order], np.searchsorted(self.limits, hits[order], side="right")


    def weight(self, s: np.ndarray) -> float:
        """How common the set's tokens are: the text that copies were made from outweighs its edited copies."""
        if not len(self.tokens) or not len(s):
            return 0.0
        at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
        return float(np.log1p(np.where(self.tokens[at] == s, self.hits[at], 0)).mean())


def allowed_misses(n: int, percent: int) -> int:
    return n - -(-percent * n // 100)


def signatures(s: np.ndarray, order: Order, percent: int) -> np.ndarray:
    """Hashes that a set shares with every set at least `percent` similar to it."""
    return marked_signatures(s, order, percent)[0]


def marked_signatures(s: np.ndarray, order: Order, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that a set shares with every set at least `percent` similar to it, and which of them are early: one of these
    is shared with every such set that is not smaller.

    The prefix grows until any `allowed_misses` of its tokens can go and one signature is still whole: a token of
    class 0 is one; of class c, every combination of c + 1 tokens of one part is. Of its smaller set a pair misses less,
    so a shorter prefix, the early one, is enough there. Parts depend on a size band: a pair meets in the band of its
    smaller set, so a set writes the combinations of its own band and of each one below that a smaller partner's size
    may lie in.
    """
    n = len(s)
    s, classes = order.of(s)
    need = allowed_misses(n, percent) + 1
    soon = n - -(-2 * percent * n // (100 + percent)) + 1
    if n < 2 * PART or not classes[:need].any():  # the bands' prefixes start with the same tokens of class 0
        found = [s[:need]]
    else:
        found = [s[:need][classes[:need] == 0]]
    early = [np.arange(len(found[0])) < soon]
    with np.errstate(over="ignore"):
        for band in range(int(-(-percent * n // 100)).bit_length() - 1, n.bit_length()):
            parts = (1 << band) // PART
            if parts < 2:
                if n >= 2 * PART:
                    found.append(s[:need])  # a smaller partner is indexed by single tokens
                    early.append(np.zeros(need, bool))
                continue
            if not classes[:need].any():
                continue
            covered, members, known = 0, {}, None
            for token, c in zip(s.tolist(), classes.tolist()):
                if c == 0:
                    covered += 1
                else:
                    own = members.setdefault((c, token % parts), [])
                    own.append(token)
                    covered += len(own) > c
                if known is None and covered >= soon:
                    known = {part: len(own) for part, own in members.items()}
                if covered >= need:
                    break
            sums, at_once = [], []
            for part, own in members.items():
                mixes = list(map(spread, own))
                most = 0 if band < n.bit_length() - 1 else len(own) if known is None else known.get(part, 0)
                for chosen in combinations(range(len(own)), part[0] + 1):
                    sums.append(sum(mixes[i] for i in chosen) & 0xFFFFFFFFFFFFFFFF)
                    at_once.append(chosen[-1] < most)
            found.append(mixed(np.array(sums, np.uint64) + np.uint64(band) * np.uint64(0x9E3779B97F4A7C15)))
            early.append(np.array(at_once, bool))
    sigs, at = np.unique(np.concatenate(found), return_inverse=True)
    marks = np.zeros(len(sigs), bool)
    marks[at[np.concatenate(early)]] = True
    return sigs, marks


def spread(x: int) -> int:
    """A 64-bit mix of one token, so that sums of tokens name combinations."""
    x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 & 0xFFFFFFFFFFFFFFFF


def signed(docs: DataFrame, order: Order, size: int, percent: int) -> DataFrame:
    """Rows (sig, early, node, n): the signatures of each distinct set of a task."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in slices(batches, 2):
            sigs, early, nodes, sizes = [], [], [], []
            for s in shingle_sets(b.column("text"), size):
                # A set that a set of one token more is not similar to is similar to its copies only.
                if 100 * len(s) < percent * (len(s) + 1) or (node := digest(s)) in seen:
                    continue
                seen.add(node)
                own, marks = marked_signatures(s, order, percent)
                sigs.append(own)
                early.append(marks)
                nodes.append(np.full(len(own), node, np.int64))
                sizes.append(np.full(len(own), len(s), np.int32))
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(early)),
                                                  pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes))],
                                                 ["sig", "early", "node", "n"])

    return docs.select("text").mapInArrow(sign, "sig long, early boolean, node long, n int")


def bitmap(s: np.ndarray, bits: int = 0) -> bytes:
    """The set hashed to `bits` bits or to at least four times as many as tokens, a power of two; each token turns its bit."""
    size = bits or 1 << max(6, int(4 * len(s) - 1).bit_length())
    marks = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(marks.astype(np.uint8), bitorder="little").tobytes()


def most_shared(a: bytes, b: bytes, n: int, m: int) -> int:
    """No two sets of n and m tokens with these bitmaps share more: each differing bit is turned by a token of one alone."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return (n + m - int(np.bitwise_count(x ^ y).sum())) // 2


def near_enough(shared, n, m, percent: int):
    """100 * shared >= percent * (n + m - shared)."""
    return (100 + percent) * shared >= percent * (n + m)


def of_nodes(docs: DataFrame, reps: DataFrame, size: int, order: Order | None = None) -> DataFrame:
    """`node` and its sorted `tokens`; or, given the order, its `bits`, its `short` bitmap and the `weight` of its tokens.

    Each set is read from one document. `reps` (node, key) is broadcast if its counted rows are few, else joined by a
    shuffle.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            sets = shingle_sets(b.column("text"), size)
            columns = {"named": pa.array([digest(s) if len(s) else None for s in sets], pa.int64()), "node": b.column("node")}
            if order:
                columns |= {"bits": pa.array([bitmap(s) for s in sets], pa.binary()), "weight": pa.array([order.weight(s) for s in sets]),
                            "short": pa.array([np.frombuffer(bitmap(s, 64 * SHORT), np.int64) for s in sets], pa.list_(pa.int64()))}
            else:
                columns["tokens"] = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    texts = docs.select("key", "text").join(bounded(reps, BROADCAST_NODES), "key")
    out = texts.select("text", "node").mapInArrow(read, "named long, node long, " + (
        "bits binary, weight double, short array<long>" if order else "tokens array<long>"))
    # A repeated key may bring another text, or the same one twice.
    return staged(out.where("named = node").drop("named").dropDuplicates(["node"]))


def beside(pairs: DataFrame, of: DataFrame, what: str) -> DataFrame:
    return (pairs.join(of.select(F.col("node").alias("a"), F.col(what).alias("x")), "a")
            .join(of.select(F.col("node").alias("b"), F.col(what).alias("y")), "b"))


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """The (a, b) of `pairs` (a, b, n, m) that are similar: bitmaps bound the overlap, then whole sets are compared."""
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = b.column("n").to_pylist(), b.column("m").to_pylist()
            keep = [near_enough(most_shared(x, y, i, j), i, j, percent)
                    for x, y, i, j in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), n, m)]
            yield b.select(["a", "b", "n", "m"]).filter(pa.array(keep, pa.bool_()))

    likely = staged(beside(pairs, nodes, "bits").select("a", "b", "n", "m", "x", "y").mapInArrow(bound, "a long, b long, n int, m int"))
    ends = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
    whole = of_nodes(docs, staged(reps.join(ends, "node", "left_semi")), size)
    shared = F.size(F.array_intersect("x", "y"))
    return staged(beside(likely, whole, "tokens").where(near_enough(shared, F.col("n"), F.col("m"), percent)).select("a", "b"))


def similar_sizes(n, m, percent: int):
    return (100 * F.least(n, m) >= percent * F.greatest(n, m))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row a row of `docs`: `doc_id`, `n_shingles` (long), `component_id`.

    Documents link when 100 * shared >= `percent` * united shingles of `size` words; `component_id` is the smallest
    doc_id reachable by links. Documents with one set are one node, so copies meet once.

    Candidates come from token-combination prefixes. A bucket holds the nodes of one signature; buckets of the same
    nodes count once. First each node is compared with its bucket's lead, the set with the commonest tokens; then, in
    buckets that still hold several components, the nodes outside the largest component meet all others that are not
    yet joined to them. A pair is only made if bitmaps, which bound the overlap from above, allow it. So a group of near
    copies makes rows in proportion to its size, and no link between two components is lost.

    Null and blank texts have no shingles and link with nothing. Rows that repeat a `doc_id` are linked through it.
    A null `doc_id` joins its text's component without naming it: links through such a text count, and rows that only
    null ids are reachable from have a null component. No rows give no rows; other columns are ignored.
    """
    python_ready(docs.sparkSession)
    text = F.col("text").cast("string")
    # Texts are found again by their key: the id, or where it is null a hash of the text.
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("key"), text.alias("text"))
    read = staged(read_sets(docs, size))
    rows = read.where("token is null").select("doc_id", "key", "node", "n")
    top = (read.where("token is not null").groupBy("token").agg(F.sum("hits").alias("hits"))
           .where(F.col("hits") >= FREQUENT[0]).orderBy(F.col("hits").desc(), "token").limit(MOST_FREQUENT).toPandas())
    order = Order(top["token"].to_numpy(np.int64).view(np.uint64), top["hits"].to_numpy(np.int64), list(FREQUENT))
    reps = staged(rows.where("node is not null").groupBy("node").agg(F.min("key").alias("key")))

    whole = staged(signed(docs, order, size, percent))
    # Reduced in tasks before the shuffle, so that a signature of many sets is one row a task.
    # A signature that is early in none of its sets is not needed.
    # Nodes are hashes, so the sum of their upper bits names a bucket; two buckets of one name are one, which loses no pair.
    named = (whole.groupBy("sig").agg(F.min("node").alias("least"), F.max("node").alias("last"), F.max("early").alias("early"),
                                      F.sum(F.shiftright("node", 24)).alias("bucket"))
             .where("early and least < last").select("sig", "bucket"))
    # Tasks name a set once each, so a set may be in a signature twice; its sums still name the bucket.
    buckets = staged(whole.select("sig", "node", "n").join(staged(named), "sig").select("bucket", "node", "n").distinct())
    nodes = of_nodes(docs, staged(reps.join(buckets.select("node").distinct(), "node", "left_semi")), size, order)
    weighed = buckets.join(nodes.select("node", "weight"), "node")
    lead = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("lead"))
    star = (buckets.join(lead, "bucket").where("node <> lead.node")
            .where(similar_sizes(F.col("n"), F.col("lead.n"), percent))
            .select(F.col("node").alias("a"), F.col("lead.node").alias("b"), "n", F.col("lead.n").alias("m")).distinct())
    first = verified(star, nodes, docs, reps, size, percent)
    joined = components(first)
    labelled = staged(buckets.join(joined, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("label")))
    largest = (labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("bucket")
               .agg(F.max(F.struct("k", "label")).alias("most"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
               .select("bucket", F.col("most.label").alias("main")))
    opened = labelled.join(largest, "bucket")
    # A pair that meets in a bucket with a smaller key is left to that one; the first keys of both tell most of them.
    firsts = opened.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("bucket")), 1, FIRST).alias("first"))
    opened = staged(opened.join(nodes.select("node", "short"), "node").join(firsts, "node"))
    other = opened.where("label <> main").select("bucket", F.col("node").alias("a"), "n", F.col("label").alias("la"),
                                                 F.col("short").alias("x"), F.col("first").alias("fa"))
    against = opened.select("bucket", F.col("node").alias("b"), F.col("n").alias("m"), F.col("label").alias("lb"), "main",
                            F.col("short").alias("y"), F.col("first").alias("fb"))
    differ = sum((F.bit_count(F.get("x", F.lit(i)).bitwiseXOR(F.get("y", F.lit(i)))) for i in range(SHORT)), F.lit(0))
    most = (F.col("n") + F.col("m") - differ) / 2
    met = other.join(against, (other["bucket"] == against["bucket"])
                     & (F.col("la") != F.col("lb")) & ((F.col("a") < F.col("b")) | (F.col("lb") == F.col("main")))
                     & similar_sizes(F.col("n"), F.col("m"), percent) & near_enough(most, F.col("n"), F.col("m"), percent)
                     & ~F.exists(F.array_intersect("fa", "fb"), lambda e: e < other["bucket"]))
    cross = met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"),
                       F.when(F.col("a") > F.col("b"), F.col("n")).otherwise(F.col("m")).alias("n"),
                       F.when(F.col("a") > F.col("b"), F.col("m")).otherwise(F.col("n")).alias("m")).distinct()
    links = staged(first.unionByName(verified(cross, nodes, docs, reps, size, percent)).distinct())
    # Rows that repeat a doc_id hold several nodes: each hangs on the smallest of them.
    repeats = (rows.where("doc_id is not null and node is not null").groupBy("doc_id")
               .agg(F.min("node").alias("least"), F.max("node").alias("last")).where("least < last").select("doc_id", "least"))
    same_id = rows.join(repeats, "doc_id").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    of_node = components(links.unionByName(same_id))
    told = staged(rows.join(of_node, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("label")))
    named = told.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return told.join(named, "label", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
