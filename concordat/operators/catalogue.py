"""Stated row counts against counted ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import grouped_digits, written_like
from .contract import union_all


def count_rows(tables: dict[str, DataFrame] | list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows per table; a bare count reads no column. Tables of one name are counted each."""
    return union_all(
        t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, t in (tables.items() if isinstance(tables, dict) else tables)
    )


def check_catalogue(claims: DataFrame, counts: DataFrame) -> DataFrame:
    """Every claim beside its count, and every counted dataset that no claim names.

    A figure is read at the precision it is written to. `rewritten` is the count in the
    form of the claim, or the claim itself where its form cannot be read.
    """
    both = claims.join(counts, "dataset", "full").withColumn(
        "measured", written_like(F.col("rows"), F.col("stated"))
    )
    finding = (
        F.when(F.col("stated").isNull(), "catalogue.missing")
        .when(F.col("rows").isNull(), "catalogue.unknown")
        .when(F.col("measured").isNull(), "catalogue.unreadable")
        .when(F.col("measured") != F.col("stated"), "catalogue.rows")
    )
    return both.select(
        "dataset",
        "stated",
        "rows",
        F.coalesce("measured", "stated").alias("rewritten"),
        finding.alias("finding"),
    )


def catalogue_violations(checked: DataFrame, catalogue: str) -> DataFrame:
    detail = F.concat(
        F.lit("states "), F.coalesce("stated", F.lit("nothing")),
        F.lit("; the table holds "), F.coalesce(grouped_digits(F.col("rows")), F.lit("no known number of")),
        F.lit(" rows"),
    )
    return checked.where(F.col("finding").isNotNull()).select(
        F.lit(catalogue).alias("package"),
        F.col("dataset").alias("resource"),
        F.lit("").alias("field"),
        F.col("finding").alias("rule"),
        detail.alias("detail"),
    )
