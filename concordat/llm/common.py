"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word, and the letters that are lower-cased.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words; zero for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(frame: DataFrame, name: str) -> str:
    """`name`, or the first longer form of it that no column of `frame` has."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where none is named, one of the working folder on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; a cluster needs a shared folder")
        folder = os.path.join(os.environ.get("TMPDIR", "/tmp"), "concordat-checkpoints")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


# Spark removes the shuffle files of a query when it ends; else they stay until the driver's heap happens to be collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(frame: DataFrame, name: str) -> DataFrame:
    """`frame` written once to the shared folder and read back: it cuts lineage and outlives any executor.

    The write's shuffle files go with it, so a chain of writes holds one write's shuffles at a time.
    """
    spark = frame.sparkSession
    path, before = scratch(spark, name), spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def written_in_buckets(frame: DataFrame, key: str, name: str) -> DataFrame:
    """As `written`, in as many buckets of `key` as there are shuffle partitions: joins on `key` then leave it in its place.

    The table's name leaves the catalogue at once; its files stay in the shared folder.
    """
    spark = frame.sparkSession
    own, path = f"llm_{uuid.uuid4().hex}", scratch(spark, name)
    frame.write.bucketBy(partitions(spark), key).option("compression", "zstd").saveAsTable(own, format="parquet", path=path)
    found = spark.table(own)
    found.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {own}")
    return found


def small_batches(frame: DataFrame, rows: int = 1000) -> DataFrame:
    """`frame`, after the session is held to `rows` rows in an Arrow batch: texts are long, and a batch is held whole."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(frame.sparkSession.conf.get(key)) <= rows:
        frame.sparkSession.conf.set(key, str(rows))
    return frame


def pieces(stream: Iterator[pa.RecordBatch], limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about `limit` bytes, or one row."""
    for batch in stream:
        step = max(1, int(batch.num_rows * limit / max(limit, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
