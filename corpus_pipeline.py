"""From raw documents to training tokens: each stage works on all rows its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs. Rows
with a null doc_id pass the stages that drop documents by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.llm.common import bounded, staged
from kermesse.llm.decontaminate import contaminated
from kermesse.llm.line_dedup import line_dedup
from kermesse.llm.ngram_jaccard import near_duplicates
from kermesse.llm.piece_sampling import encode
from kermesse.llm.toxicity import toxicity

#: A document with at least this score is rejected as toxic.
TOXIC = 0.7
#: Ids that are broadcast to pick or drop documents; more are joined by a shuffle.
BROADCAST_IDS = 5_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    rejected = toxicity(docs, labels).where(F.col("score") >= TOXIC).select("doc_id").dropna().distinct()
    return docs.join(bounded(staged(rejected), BROADCAST_IDS), "doc_id", "left_anti").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the first of them."""
    return line_dedup(docs).select(docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays, once."""
    groups = near_duplicates(docs)
    others = staged(groups.where("doc_id <> component_id").select("doc_id").distinct())
    kept = docs.join(bounded(others, BROADCAST_IDS), "doc_id", "left_anti").select(docs.columns)
    # A repeated doc_id is a repeated row of the document that stays; as a rule there is none.
    repeated = staged(groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    repeated = bounded(repeated, BROADCAST_IDS)
    once = kept.join(repeated, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = staged(contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct())
    return docs.join(bounded(found, BROADCAST_IDS), "doc_id", "left_anti").select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as sampled pieces."""
    return encode(docs).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_duplicates", keep_one_of_near_duplicates),
          ("decontamination", drop_contaminated), ("piece_encoding", encode_pieces)]

#: Scores and sampled pieces have no SQL; tests/llm hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
