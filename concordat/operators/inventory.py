"""Declared sizes and digests against measured ones, and digests of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def verify_objects(declared: DataFrame, measured: DataFrame) -> DataFrame:
    """Both statements about each object side by side, and what is wrong.

    `stamped_bytes` and `stamped_hash` are what the descriptor should say: the
    measurement where there is one, what was declared where there is none.
    """
    d = declared.select("object", F.col("bytes").alias("declared_bytes"), F.col("hash").alias("declared_hash"))
    both = d.join(measured, "object", "left")
    finding = (
        F.when(F.col("bytes").isNull(), "object.missing")
        .when(F.col("declared_bytes") != F.col("bytes"), "resource.bytes")
        .when(F.col("declared_hash") != F.col("hash"), "resource.hash")
    )
    return both.select(
        "object",
        "declared_bytes",
        "bytes",
        finding.alias("finding"),
        F.coalesce("bytes", "declared_bytes").alias("stamped_bytes"),
        F.coalesce("hash", "declared_hash").alias("stamped_hash"),
    )


def content_digest(table: DataFrame, resource: str) -> DataFrame:
    """One row that changes when any row does, whatever the order of the rows.

    Two independent hashes per row are summed wide enough that neither can overflow, so
    the digest needs no shuffle but that of one row per task. A hash passes over a NULL, so
    each column is hashed with whether it is one: a NULL that moves to another column counts.
    """
    names = [F.col(f"`{c}`") for c in sorted(table.columns)]
    columns = [part for c in names for part in (c.isNull(), c)]
    wide = "decimal(38,0)"
    return table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64(*columns).cast(wide)), F.lit(0).cast(wide)).alias("digest"),
        F.coalesce(F.sum(F.xxhash64(F.lit(97), *reversed(columns)).cast(wide)), F.lit(0).cast(wide)).alias("check"),
    ).select(F.lit(resource).alias("resource"), "rows", "digest", "check")


def unchanged(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whether the digests of the same resources agree."""
    both = before.withColumn("late", F.lit(False)).unionByName(after.withColumn("late", F.lit(True)))
    late = F.col("late")
    state = F.struct("rows", "digest", "check")
    return both.groupBy("resource").agg(
        F.sum(F.when(~late, F.col("rows"))).alias("rows"),
        F.sum(F.when(late, F.col("rows"))).alias("rows_after"),
        (F.count_if(~late) == 1).alias("had"),
        (F.count_if(late) == 1).alias("has"),
        (F.min(state) == F.max(state)).alias("same"),
    ).select("resource", "rows", "rows_after", (F.col("had") & F.col("has") & F.col("same")).alias("unchanged"))
