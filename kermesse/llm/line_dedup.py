"""Lines that several documents share stay only in the document with the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kermesse.llm.common import BLANKS, ascii_lower

MIN_CHARS = 10
MIN_DOCS = 2


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`docs` with `text` less the repeated lines, and `n_lines`, `n_dropped` (long).

    Lines are split at line feeds; a line's key is the line without blanks at its ends, A-Z in lower case. Keys
    of at least `min_chars` code points that at least `min_docs` documents hold keep their lines in the smallest
    `doc_id` only; a key repeated inside one document counts that document once and all its lines stay or go
    together. Only hashes and positions are shuffled by key, reduced before the shuffle, so a line that a third of
    all documents share is one row a task; its positions are joined back by key, where Spark splits skewed ones.

    A null or empty text is one empty line. Rows with a null `doc_id` hold no key and lose nothing. Rows that
    repeat a `doc_id` are one document. No rows give no rows. Other columns pass through; columns named like the
    results are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = F.split(text, "\n")
    row = F.xxhash64(text)  # tells rows that repeat a doc_id apart
    key = ascii_lower(F.btrim("_line", F.lit(BLANKS)))
    hashes = (F.xxhash64("_key"), F.xxhash64(F.lit(1), "_key"))  # 128 bits: two lines never meet by chance
    lines = (docs.where(F.col("doc_id").isNotNull())
             .select(F.col("doc_id").alias("_doc"), row.alias("_row"), F.posexplode(split).alias("_pos", "_line"))
             .select("_doc", "_row", "_pos", key.alias("_key"))
             .where(F.length("_key") >= min_chars)
             .select("_doc", "_row", "_pos", hashes[0].alias("_h1"), hashes[1].alias("_h2")))
    held = lines.groupBy("_h1", "_h2")
    if min_docs == 2:  # two distinct documents hold it if the smallest and the largest id differ
        shared = held.agg(F.min("_doc").alias("_keeper"), F.max("_doc").alias("_last")).where("_keeper < _last")
    else:
        shared = (held.agg(F.min("_doc").alias("_keeper"), F.count_distinct("_doc").alias("_docs"))
                  .where(F.col("_docs") >= min_docs))
    dropped = (lines.join(shared.select("_h1", "_h2", "_keeper"), ["_h1", "_h2"])
               .where("_doc <> _keeper").groupBy("_doc", "_row").agg(F.collect_set("_pos").alias("_dropped")))
    own = docs.withColumns({"_row": row, "n_lines": F.size(split).cast("long")})
    joined = own.join(dropped.hint("shuffle_hash"), (own["doc_id"] == dropped["_doc"])
                      & (own["_row"] == dropped["_row"]), "left")
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_dropped")))
    kept = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda at: F.get(split, at)), "\n"))
    count = F.coalesce(F.size("_dropped"), F.lit(0)).cast("long")
    return joined.select(*[kept.alias("text") if c == "text" else own[c] for c in docs.columns
                           if c not in ("n_lines", "n_dropped")],
                         own["n_lines"], F.greatest(count, F.lit(0)).alias("n_dropped"))
