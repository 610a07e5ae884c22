"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kermesse.session import ensure_checkpoint_dir, ship_package

#: The white space that separates words, and the letters that lose their case.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a shingle, and the similarity of near duplicates.
SHINGLE_WORDS = 5
NEAR = 0.75


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Words of a text between blanks; null or blank: none."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def utf8_sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def staged(df: DataFrame, folders: str | None = None) -> DataFrame:
    """Write a step to the shared checkpoint folder as Parquet and read it back.

    Columns prune on later reads, and a lost executor costs no earlier work. A column of small numbers may name folders.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = f"{ensure_checkpoint_dir(spark)}/staged-{jvm.java.util.UUID.randomUUID()}"
    (df.write.partitionBy(folders) if folders else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Mark a small table for broadcast if its counted rows are within the bound; else leave it to be shuffled.

    `df` should be staged, as it is counted here.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes of a batch that is handed to a Python worker, unless the cluster names its own.
BATCH_BYTES = 4_000_000


def python_ready(spark: SparkSession) -> None:
    """The Python workers import this package, and texts reach them in batches of bounded size."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(BATCH_BYTES))


class Remembered(dict):
    """What a task has worked out before, by string; emptied when it passes `most` bytes, by estimate."""

    def __init__(self, most: int = 48_000_000):
        super().__init__()
        self.most, self.bytes = most, 0

    def keep(self, key: str, value):
        self.bytes += 200 + len(key)
        if self.bytes > self.most:
            self.clear()
            self.bytes = 0
        self[key] = value
        return value


def slices(batches: Iterator[pa.RecordBatch], mb: float = 8) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about `mb` of data, or one row."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * mb * 1e6 / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
