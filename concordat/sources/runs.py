"""Run records: what a build run produced and which of its steps got there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import parse_once

# Fixed value: the record version this reader understands.
CONTRACT_VERSION = "b4/1"

SCHEMA = """
contract_version string,
run struct<run_id string, started_at string, outcome string>,
assets array<struct<kind string, name string, path string, bytes bigint,
                    content_hash string, produced_by string>>,
steps array<struct<name string, status struct<state string, skip_reason string>>>
"""


def parse_runs(texts: DataFrame, column: str, source: str) -> DataFrame:
    """One row per record. `error` says why a record cannot be read; it is never dropped.

    `source` names the column that says where a record came from.
    """
    parsed = texts.select(F.col(source).alias("source"), parse_once(F.col(column), SCHEMA))
    version = F.col("contract_version")
    error = (
        F.when(
            version.isNull() & F.col("run").isNull() & F.col("assets").isNull() & F.col("steps").isNull(),
            "is not a readable run record",
        )
        .when(
            ~version.eqNullSafe(F.lit(CONTRACT_VERSION)),
            F.concat(F.lit("declares contract version "), F.coalesce(version, F.lit("none"))),
        )
        .when(F.col("run").isNull(), "declares no run block")
        .when(F.col("steps").isNull() | F.col("assets").isNull(), "declares no steps or assets")
    )
    return parsed.select(
        "source",
        error.alias("error"),
        F.coalesce("run.run_id", "source").alias("run_id"),
        F.coalesce("run.started_at", F.lit("")).alias("started_at"),
        F.coalesce("run.outcome", F.lit("None")).alias("outcome"),
        "assets",
        "steps",
    )


def read_runs(spark: SparkSession, pattern: str) -> DataFrame:
    texts = spark.read.text(pattern, wholetext=True)
    return parse_runs(texts.select("value", F.col("_metadata.file_path").alias("path")), "value", "path")
