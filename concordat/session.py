"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. Joins whose big side may carry a hot key are
# plain equi-joins against a side with one row per key, which is the shape adaptive
# execution can split; forcing the split keeps it on when an aggregate follows the join.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where no folder is set and the master is local does this make one of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; a cluster needs a shared folder")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="concordat-"))
    return context.getCheckpointDir()


def staged(table: DataFrame, name: str) -> DataFrame:
    """`table` written once to the shared folder and read back.

    For a result that several later steps read: it is worked out once, survives the loss
    of any executor, and its real size is known to the planner.
    """
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def unsized(table: DataFrame) -> DataFrame:
    """`table` marked for a sorted join, whose sides stay on executors.

    For rows taken out of parsed texts: the planner sizes them by the files the texts come from, and would
    send millions of them through the driver as a broadcast. An adaptive plan still splits a hot key.
    """
    return table.hint("merge")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/concordat-{uuid.uuid4().hex}/{name}"
