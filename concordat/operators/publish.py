"""Write, audit, publish: a table is staged, gated in the plan, and named by a manifest row.

Readers follow the manifest, so a staged table that no row names was never published. The row is
written by the very plan that audits the staged files: where the gate finds something, an error inside
its CASE stops that write, and nothing is published.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .edges import GateError, gate_report
from .export import export_ordered, order_report, ranked_rows

MANIFEST = "run string, path string, rows bigint, state string, at timestamp"


def refuse_when(found: Column, message: Column, otherwise: Column) -> Column:
    """`otherwise`, or an error with `message` where `found` holds: a gate inside a plan."""
    return F.when(found, F.raise_error(message).cast("string")).otherwise(otherwise)


def audited(staged: DataFrame, register: DataFrame, path: str, order: list[str]) -> DataFrame:
    """One row: rows, what the identifier gate finds, and rows or files out of order."""
    spark = staged.sparkSession
    report = order_report(spark, path, order).select("rows", (F.col("out_of_order") + F.col("overlapping_files")).alias("misplaced"))
    both = gate_report(staged, register).unionByName(report, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("rows", "misplaced", "edges", "distinct_ids", "examples")])


def publish_edges(table: DataFrame, register: DataFrame, folder: str, order: list[str], rows_per_group: int = 50_000) -> str:
    """Publish edges under `folder` in a total order; the path published, or a GateError and no manifest row.

    The table is written once, and audited as written. `order` must end in columns that together are unique.
    """
    run = uuid.uuid4().hex
    path = f"{folder.rstrip('/')}/runs/{run}"
    export_ordered(table, path, order, rows_per_group)
    spark = table.sparkSession
    told = audited(spark.read.schema(table.schema).parquet(path), register, path, order)
    text = F.concat(
        F.col("edges").cast("string"), F.lit(" edge(s) carry "), F.col("distinct_ids").cast("string"),
        F.lit(" identifier(s) that name nothing, e.g. "), F.col("examples"), F.lit("; "),
        F.col("misplaced").cast("string"), F.lit(" row(s) or file(s) out of order"),
    )
    state = refuse_when((F.col("edges") > 0) | (F.col("misplaced") > 0), text, F.lit("published"))
    row = told.select(
        F.lit(run).alias("run"), F.lit(path).alias("path"), "rows", state.alias("state"), F.current_timestamp().alias("at")
    )
    try:
        row.write.mode("append").parquet(f"{folder.rstrip('/')}/manifest")
    except PySparkException as error:
        if "USER_RAISED_EXCEPTION" not in str(error):
            raise
        raise GateError(str(error)) from error
    return path


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """What was published under `folder`, one row a run."""
    return spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")


def read_published(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the newest run that was published, with their place in its order as `rank`."""
    newest = manifest(spark, folder).orderBy(F.col("at").desc(), "run").limit(1).collect()
    if not newest:
        raise GateError(f"nothing is published under {folder}")
    return ranked_rows(spark, newest[0].path)
