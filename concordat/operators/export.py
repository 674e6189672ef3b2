"""Ordered Parquet export, and a table's description carried in its own files."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import contract
from .documents import document_diff

# The column metadata key under which the description travels, and fixed values: the
# members of a resource that a file cannot state about itself.
DESCRIPTION = "datapackage"
SELF_REFERENTIAL = ("bytes", "hash")


def export_ordered(
    table: DataFrame, path: str, order: list[str], rows_per_group: int, codec: str = "zstd", files: int | None = None
) -> None:
    """Write a total order: files by range, rows sorted in each, so equal input gives equal rows
    in equal places. The order must end in columns that together are unique."""
    parts = (files, *order) if files else order
    (
        table.repartitionByRange(*parts)
        .sortWithinPartitions(*order)
        .write.option("compression", codec)
        .option("parquet.block.row.count.limit", rows_per_group)
        .mode("errorifexists")
        .parquet(path)
    )


# Rows of a file that one task compares.
SLICE = 1 << 20


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of exported files with the file each lies in, and its place there."""
    return spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )


def order_report(spark: SparkSession, path: str, order: list[str], slice_rows: int = SLICE) -> DataFrame:
    """One row: files, rows, rows out of order within a file, files that overlap.

    A file is compared in slices of its row numbers. The last row of a slice is handed to the next one, too,
    so every row meets the one before it, and no task sorts more than a slice. Files are compared by their
    least and greatest key; the window over files holds one row per file.
    """
    slice_ = F.floor(F.col("_at") / slice_rows)
    ends = F.when((F.col("_at") + 1) % slice_rows == 0, F.array(slice_, slice_ + 1)).otherwise(F.array(slice_))
    rows = _placed(spark, path).select(
        F.struct(*order).alias("key"), "_file", "_at", slice_.alias("own"), F.explode(ends).alias("slice")
    )
    within = Window.partitionBy("_file", "slice").orderBy("_at")
    steps = rows.withColumn("before", F.lag("key").over(within)).where("own = slice")
    files = steps.groupBy("_file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("key") < F.col("before")).alias("out_of_order"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
    )
    between = Window.orderBy("_file")
    return files.withColumn("last", F.lag("high").over(between)).agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("out_of_order"), F.lit(0)).alias("out_of_order"),
        F.count_if(F.col("low") < F.col("last")).alias("overlapping_files"),
    )


def ranked_rows(spark: SparkSession, path: str) -> DataFrame:
    """Exported rows with their place in the whole order, from 1: what earlier files hold, and their own place.

    Nothing is sorted: files are counted, one row each, and their counts added up.
    """
    rows = _placed(spark, path)
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    bases = counts.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "_file").withColumn("rank", F.col("_base") + F.col("_at") + 1).drop("_file", "_at", "_base")


def carried_form(descriptor: dict) -> dict:
    """The descriptor as a file can carry it: without its own size and digest."""
    carried = dict(descriptor)
    carried["resources"] = [
        {k: v for k, v in resource.items() if k not in SELF_REFERENTIAL}
        for resource in descriptor.get("resources") or []
    ]
    return carried


def with_description(table: DataFrame, descriptor: dict) -> DataFrame:
    """The table with its description on its first column; Parquet keeps it in the footer."""
    first = table.columns[0]
    text = json.dumps(carried_form(descriptor), sort_keys=True, ensure_ascii=False)
    return table.withMetadata(first, {DESCRIPTION: text})


def read_description(table: DataFrame) -> str | None:
    """The description a table carries, if any; two would be no description."""
    found = [f.metadata[DESCRIPTION] for f in table.schema.fields if DESCRIPTION in f.metadata]
    if len(found) > 1:
        raise contract.ContractError(f"{len(found)} descriptions in one table")
    return found[0] if found else None


def check_self_description(
    table: DataFrame, descriptor: dict, package: str, resource: str, require: bool = False
) -> DataFrame:
    """The carried description against the kept one, and against the table that carries it."""
    spark = table.sparkSession

    def finding(detail: str) -> DataFrame:
        return spark.createDataFrame([(package, resource, "", "self-description", detail)], contract.VIOLATION)

    none = spark.createDataFrame([], contract.VIOLATION)
    text = read_description(table)
    if text is None:
        return finding("carries no description of itself") if require else none
    try:
        carried = json.loads(text)
    except json.JSONDecodeError:
        return finding("carries a description that is not JSON")
    if not isinstance(carried, dict):
        return finding("carries a description that is no JSON object")

    parts = [none]
    stated = [r for r in carried.get("resources") or [] if isinstance(r, dict)]
    for own in stated:
        parts += [finding(f"states its own {k} inside itself") for k in SELF_REFERENTIAL if k in own]

    def one(document: dict) -> DataFrame:
        body = json.dumps(document, ensure_ascii=False)
        return spark.createDataFrame([(resource, body)], "resource string, body string")

    differing = document_diff(one(carried_form(descriptor)), one(carried), "resource", "body")
    parts.append(
        contract.violations(
            differing.withColumns(
                {"package": F.lit(package), "field": F.lit(""), "rule": F.lit("self-description")}
            ),
            "differs at ", F.col("pointer"), ": ", F.col("finding"),
        )
    )
    physical = contract.physical_fields(table, package, resource)
    declared_schema = T.StructType.fromDDL("package string, resource string, field string, type string")
    for own in stated:
        schema = own.get("schema") or {}
        fields = [f for f in schema.get("fields") or [] if isinstance(f, dict)]
        rows = [(package, resource, f.get("name"), f.get("type", "any")) for f in fields]
        declared = spark.createDataFrame(rows, declared_schema)
        inner = contract.check_field_set(declared, physical).unionByName(contract.check_types(declared, physical))
        parts.append(inner.withColumn("rule", F.concat(F.lit("self-description."), "rule")))
        if "primaryKey" in schema:
            key = schema["primaryKey"]
            columns = [key] if isinstance(key, str) else key
            readable = isinstance(columns, list) and all(isinstance(c, str) for c in columns)
            parts.append(
                contract.check_primary_key(
                    table, columns if readable else None, package, resource, "self-description."
                )
            )
    return reduce(DataFrame.unionByName, parts)
