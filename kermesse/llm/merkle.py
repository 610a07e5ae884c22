"""A content-addressed manifest of a dataset: a Merkle tree per source, a tree over the sources, and proofs of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kermesse.llm.common import bounded, staged

#: Children of a node, and the levels of a tree that one shuffle builds and one record keeps together.
FAN, LEVELS = 3, 3
#: Rows of the table of offsets (partitions and groups) that are broadcast; more are joined by a shuffle.
BROADCAST_OFFSETS = 500_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Digest of a row: each field as `-` if null, else its UTF-8 byte count, `:` and its value."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
             for c in columns.values()]
    return hashed(F.concat(*parts))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `rank` (long, from 0): their place in their `group` (null is one) by `order`.

    Rows are sorted across partitions; a group that spans several starts where the earlier ones end. No group is
    gathered anywhere. Rows that tie are numbered as they come, so equal ones may change places.
    """
    at = staged(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    runs = staged(at.groupBy("_part", group).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n")))
    # One row a partition and group: a group has as many as partitions, however many rows.
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("_part", "_from", F.col(group).alias("_group"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    offsets = bounded(staged(offsets), BROADCAST_OFFSETS).withColumnRenamed("_part", "_p")
    joined = at.join(offsets, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("rank", F.col("_at") - F.col("_from") + F.col("_before")).select(*rows.columns, "rank")


def grown(nodes: DataFrame) -> DataFrame:
    """The next LEVELS levels over nodes (grp, depth, height, rank, digest), or fewer where the root is reached: one record
    (grp, depth, height, rank, digest, built) for each new top node.

    `built` is one array a level, from the lowest, of the level's nodes as arrays of the digests of their children.
    `depth` is the height of the group's root. A run is FAN successive nodes; the last may hold fewer.
    """
    size = FAN ** LEVELS
    blocks = (nodes.groupBy("grp", "depth", "height", F.floor(F.col("rank") / size).alias("rank"))
              .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("_row")))
    blocks = blocks.withColumn("_row", F.transform("_row", lambda x: x["digest"]))
    built = []
    for i in range(1, LEVELS + 1):
        open_ = F.col("height") + i <= F.col("depth")
        runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size("_row") / FAN).cast("int") - 1), lambda k: F.slice("_row", k * FAN + 1, FAN))
        blocks = blocks.withColumn(f"_l{i}", F.when(open_, runs))
        blocks = blocks.withColumn("_row", F.when(open_, F.transform(f"_l{i}", lambda c: hashed(F.array_join(c, "")))).otherwise(F.col("_row")))
        built.append(F.col(f"_l{i}"))
    return blocks.select("grp", "depth", "height", "rank", F.get("_row", F.lit(0)).alias("digest"), F.array_compact(F.array(*built)).alias("built"))


def tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The roots (grp, depth, digest) of the groups of `leaves` (grp, rank, digest), and the records (height, digest, built)
    under them, `height` being that of the nodes below a record.

    Several levels are built in a group of at most FAN ** LEVELS nodes, so the shuffles are few and none gathers more.
    """
    counts = leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    depth, reach = F.lit(0), 1  # the least power of FAN that reaches the count, in whole numbers
    while reach <= 2 ** 60:
        depth, reach = depth + (F.col("_n") > F.lit(reach)).cast("int"), reach * FAN
    counts = staged(counts.select("grp", depth.alias("depth")))
    top = counts.agg(F.max("depth")).first()[0] or 0
    sized = bounded(counts, BROADCAST_OFFSETS).withColumnRenamed("grp", "_grp")
    nodes = leaves.join(sized, F.col("grp").eqNullSafe(F.col("_grp"))).select("grp", "depth", F.lit(0).alias("height"), "rank", "digest")
    roots = nodes.where("depth = 0").select("grp", "depth", "digest")
    records = None
    for height in range(0, top, LEVELS):
        blocks = staged(grown(nodes.where(F.col("depth") > height)))
        own = blocks.select("height", "digest", "built")
        records = own if records is None else records.unionByName(own)
        nodes = blocks.select("grp", "depth", F.lit(height + LEVELS).alias("height"), "rank", "digest")
        roots = roots.unionByName(nodes.where(F.col("depth") <= F.col("height")).select("grp", "depth", "digest"))
    if records is None:  # one leaf at most in every group
        records = leaves.select(F.lit(0).alias("height"), "digest", F.array(F.array(F.array("digest"))).alias("built")).where("false")
    return staged(roots), records


def manifest(leaves: DataFrame) -> dict[str, DataFrame]:
    """The store of a dataset of leaves (grp, rank, digest), `grp` a row's source.

    `records` (height, digest, built) is content-addressed: a digest leads to its children, and to theirs for LEVELS
    levels, stored once however often it occurs. `groups` (_all, grp, grp_rank, depth, subroot) lists the sources'
    trees, `root` (_all, depth, root) the tree over them; `_all` is one value.
    """
    subroots, records = tree(leaves)
    order = staged(ranked(subroots.select(F.lit(0).alias("_all"), "grp", "depth", "digest"), "_all", ["grp"]))  # null first, bytewise
    root, more = tree(order.select(F.col("_all").alias("grp"), "rank", "digest"))
    return {"records": staged(records.unionByName(more).dropDuplicates(["height", "digest"])),
            "groups": order.select("_all", "grp", F.col("rank").alias("grp_rank"), "depth", F.col("digest").alias("subroot")),
            "root": root.select(F.col("grp").alias("_all"), "depth", F.col("digest").alias("root"))}


def children(records: DataFrame) -> DataFrame:
    """The records of single nodes: digest, children."""
    runs = records.select(F.explode(F.flatten("built")).alias("children"))
    return runs.select(hashed(F.array_join("children", "")).alias("digest"), "children").dropDuplicates(["digest"])


PATH = "array<struct<at: int, others: array<string>>>"


def descended(starts: DataFrame, requests: DataFrame, records: DataFrame, keys: list[str]) -> DataFrame:
    """Requests (keys, rank, depth, ...) with `found`, the digest of the leaf they name, and `path`, from the root down.

    `starts` (keys, depth, digest, path) holds the roots. Requests that share the digits of their ranks so far descend
    as one row, so a step costs as many rows as it has nodes asked for; only the last has a row a request. Each step
    looks the digest up among the records, takes the children that the next LEVELS digits select, and adds a path
    segment: the digits and the children not selected.
    """
    top = starts.agg(F.max("depth")).first()[0] or 0
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    front = starts.select(*keys, "depth", F.lit(0).cast("long").alias("prefix"), "digest", "path")
    told = None
    for base in reversed(range(0, top, LEVELS)):
        levels = F.least(F.lit(LEVELS), F.col("depth") - base)
        wanted = requests.where(F.col("depth") > base)
        wanted = (wanted.select(*keys, "depth", F.floor(F.col("rank") / FAN ** base).alias("next")).distinct() if base
                  else wanted.withColumn("next", F.col("rank")))
        wanted = wanted.withColumn("_levels", levels).withColumn("_up", F.floor(F.col("next") / F.pow(F.lit(float(FAN)), F.col("_levels"))).cast("long"))
        opened = front.where(F.col("depth") > base).join(records.where(F.col("height") == base).select("digest", "built"), "digest")
        met = opened.alias("o").join(wanted.alias("w"), (F.col("o.prefix") == F.col("w._up")) & _all(same("o", "w")))
        inside = F.pmod(F.col("w.next"), F.lit(FAN ** LEVELS))  # the node's place under the record
        steps = []
        for level in reversed(range(1, LEVELS + 1)):
            digit = F.pmod(F.floor(F.col("w.next") / FAN ** (level - 1)), F.lit(FAN)).cast("int")
            own = F.get(F.get("o.built", F.lit(level - 1)), F.floor(inside / FAN ** level).cast("int"))
            steps.append(F.when(F.col("w._levels") >= level, F.struct(digit.alias("at"), F.filter(own, lambda c, i: i != digit).alias("others"))))
        path = F.concat("o.path", F.array_compact(F.array(*steps)))
        child = F.get(own, digit)
        if base:
            met = met.select(*(f"o.{k}" for k in keys), "o.depth", F.col("w.next").alias("prefix"), child.alias("digest"), path.alias("path"))
            front = staged(met.unionByName(front.where(F.col("depth") <= base)))
        else:
            told = met.select(*(f"w.{c}" for c in requests.columns), child.alias("found"), path.alias("path"))
    # A tree of one leaf is its root.
    single = requests.where("depth = 0").alias("w").join(front.where("depth = 0").alias("o"), _all(same("o", "w"))).select(
        *(f"w.{c}" for c in requests.columns), F.col("o.digest").alias("found"), "o.path")
    return single if told is None else told.unionByName(single)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings, from the leaf up, lead to."""
    return F.aggregate(path, digest, lambda own, step: hashed(F.concat(
        F.array_join(F.slice(step["others"], F.lit(1), step["at"]), ""), own,
        F.array_join(F.slice(step["others"], step["at"] + 1, F.lit(FAN)), ""))))


def proofs(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row a row of `docs`: `doc_id`, `leaf`, `subroot`, `root`, `siblings` (array of digests from the leaf up),
    `folded_root` and `verified`.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Per source the leaves ascend by doc_id; every FAN
    successive nodes become the digest of their digests, until one is left; the sources' roots, null first, likewise
    give the root. `folded_root` is found from the leaf of `tampered`, a text in place of the row's own, with the
    siblings of the untampered tree.

    The store holds digest-to-children records. All rows ask for their proofs at once: requests descend from the root by
    the digits of the source's place and of the row's rank, collect the children not selected, and reverse the segments
    of the path.

    Nulls are values of their own: a null source is one source, a null doc_id comes first. Rows that repeat a doc_id are
    leaves of their own, in the order of their digests; equal rows have equal leaves and take neighbouring places. Empty
    and long texts are leaves like others. A lone row is its own root, without siblings. No rows give no rows. Other
    columns are ignored.
    """
    columns = {c: F.col(c) for c in FIELDS}
    changed = leaf_digest(columns | {"text": F.coalesce(tampered, F.lit(None).cast("string"))}) if tampered is not None else F.lit(None).cast("string")
    rows = docs.select(F.col("source").cast("string").alias("grp"), F.col("doc_id"), leaf_digest(columns).alias("digest"), changed.alias("_changed"))
    leaves = staged(ranked(rows, "grp", ["doc_id", "digest"]))
    store = manifest(leaves.select("grp", "rank", "digest"))
    groups, records = store["groups"], store["records"]
    none = F.lit(None).cast(PATH)
    root = store["root"].withColumn("path", F.coalesce(none, F.expr(f"cast(array() as {PATH})")))
    asked = groups.select("_all", F.col("grp_rank").alias("rank"), F.col("depth").alias("_depth"), "grp", "subroot").join(
        F.broadcast(root.select("_all", "depth", "root")), "_all")  # the root is one row
    tops = staged(descended(root.select("_all", "depth", F.col("root").alias("digest"), "path"), asked, records, ["_all"]))
    starts = tops.select("grp", F.col("_depth").alias("depth"), F.col("found").alias("digest"), "path", "subroot", "root")
    sized = bounded(staged(starts.select(F.col("grp").alias("_grp"), "depth", "subroot", "root")), BROADCAST_OFFSETS)
    requests = leaves.join(sized, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
    told = descended(starts.select("grp", "depth", "digest", "path"), requests, records, ["grp"])
    path = F.reverse("path")
    fold = folded(F.coalesce("_changed", "digest"), path)
    return (told.withColumns({"siblings": F.flatten(F.transform(path, lambda s: s["others"])), "folded_root": fold})
            .select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "siblings", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))
