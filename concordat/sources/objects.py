"""Published files seen as objects: size, digest, Parquet layout."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import file_system, list_files, open_uri

BLOCK = 8 * 1024 * 1024


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            digest, size = hashlib.sha256(), 0
            with open_uri(path) as stream:
                while block := stream.read(BLOCK):
                    digest.update(block)
                    size += len(block)
            found.append((path, size, "sha256:" + digest.hexdigest()))
        yield pd.DataFrame(found, columns=["path", "bytes", "hash"])


def object_inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """Size and SHA-256 of every file, measured in one pass over its bytes.

    Files are spread over tasks by size and streamed block by block, so neither a large
    file nor many small ones are held in memory. Spark lists no file without content, so
    such an object counts as missing.
    """
    return list_files(spark, pattern).select("path").mapInPandas(
        _digests, "path string, bytes bigint, hash string"
    )


def text_inventory(objects: DataFrame, name: str, content: str) -> DataFrame:
    """The same measurement for objects that are values of a table."""
    raw = F.col(content).cast("binary")
    return objects.select(
        F.col(name).alias("object"),
        F.octet_length(raw).cast("bigint").alias("bytes"),
        F.concat(F.lit("sha256:"), F.sha2(raw, 256)).alias("hash"),
    )


def _layouts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            filesystem, place = file_system(path)
            meta = pyarrow.parquet.read_metadata(place, filesystem=filesystem)
            for group in range(meta.num_row_groups):
                part = meta.row_group(group)
                codecs = sorted({part.column(c).compression.lower() for c in range(part.num_columns)})
                found.append((path, group, part.num_rows, ",".join(codecs)))
        yield pd.DataFrame(found, columns=["path", "row_group", "rows", "codecs"])


def parquet_row_groups(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per row group, read from the footers alone."""
    return list_files(spark, pattern).select("path").mapInPandas(
        _layouts, "path string, row_group bigint, rows bigint, codecs string"
    )


def parquet_layout(row_groups: DataFrame) -> DataFrame:
    """The layout to carry over when files are rewritten; mixed codecs are not one layout."""
    one = (F.min("codecs") == F.max("codecs")) & ~F.min("codecs").contains(",")
    return row_groups.agg(
        F.count_distinct("path").alias("files"),
        F.count(F.lit(1)).alias("row_groups"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.max("rows").alias("widest_row_group"),
        F.when(one, F.min("codecs")).alias("codec"),
    )
