"""Raw sources, read as text first; casts happen where a model asks for them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_BLOCK = 64 * 1024
POSITIONAL = "fields array<string>, data array<array<string>>"


def read_text_table(
    spark: SparkSession, path: str | list[str], delimiter: str = ",", multiline: bool = False
) -> DataFrame:
    """A headered CSV or TSV, or many with one header, every column as text.

    Quotes inside a quoted value are doubled. `multiline` allows line breaks inside a
    value, at the price of one task per file, so it is off unless asked for.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )


def parse_once(text: Column, schema: str) -> Column:
    """A generator for the fields of a JSON text.

    Written as a generator so that a filter on the fields is not moved below it, where it
    would parse the text again for each field it names.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Path and size of every file a pattern names; the content is not read."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("bytes"))


def file_system(uri: str):
    """The file system a path belongs to, and the path within it."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    return pyarrow.fs.FileSystem.from_uri(uri)


def open_uri(uri: str, compression: str | None = None):
    filesystem, path = file_system(uri)
    return filesystem.open_input_stream(path, compression=compression)


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            head = b""
            with open_uri(path, "detect") as stream:
                while b"\n" not in head and (block := stream.read(HEADER_BLOCK)):
                    head += block
            found.append((path, head.split(b"\n")[0].decode("utf-8").rstrip("\r")))
        yield pd.DataFrame(found, columns=["path", "header"])


def read_union_by_name(spark: SparkSession, pattern: str, delimiter: str = "\t") -> DataFrame:
    """Releases whose columns come in another order, or are missing, united by name.

    One scan of many files takes its header from one of them and would label the others'
    columns wrongly, so files are grouped by their own header, which tasks read off their
    first lines, and there is one scan per distinct header.
    """
    headers = list_files(spark, pattern).select("path").mapInPandas(_first_lines, "path string, header string")
    by_header: dict[str, list[str]] = {}
    for row in headers.collect():
        by_header.setdefault(row.header, []).append(row.path)
    if not by_header:
        raise FileNotFoundError(f"no file matches {pattern}")
    parts = [read_text_table(spark, sorted(by_header[header]), delimiter) for header in sorted(by_header)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_positional_json(spark: SparkSession, path: str) -> DataFrame:
    """Documents holding a list of column names and a list of rows by position."""
    return spark.read.schema(POSITIONAL).option("multiLine", True).json(path)


def unpack_positional(documents: DataFrame, names: dict[str, str]) -> DataFrame:
    """One output row per positional row, each column found by the name it has in `fields`.

    `names` maps output columns to source columns. Columns of `documents` other than
    `fields` and `data` are kept. A source column the header lacks gives NULL.
    """
    kept = [c for c in documents.columns if c not in ("fields", "data")]

    def cell(source: str) -> Column:
        at = F.array_position("fields", source)
        return F.when(at > 0, F.get("row", (at - 1).cast("int")))

    return documents.select(*kept, "fields", F.explode("data").alias("row")).select(
        *kept, *[cell(source).alias(target) for target, source in names.items()]
    )
