"""Column profiles, and the curated half of a descriptor laid over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_text

# A column with no more distinct values than this gets its values listed, unless told otherwise.
DOMAIN_LIMIT = 50

# The declared type each physical type is described as.
DECLARED = {
    "string": "string", "boolean": "boolean", "date": "date", "timestamp": "datetime",
    "timestamp_ntz": "datetime", "float": "number", "double": "number",
    "tinyint": "integer", "smallint": "integer", "int": "integer", "bigint": "integer",
}


def declared_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return "number"
    if isinstance(kind, T.ArrayType):
        return "array"
    if isinstance(kind, (T.StructType, T.MapType, T.VariantType)):
        return "object"
    return DECLARED.get(kind.simpleString(), "any")


def melt(table: DataFrame) -> DataFrame:
    """One row per value: column and value as text."""
    cells = [
        F.struct(F.lit(f.name).alias("column"), as_text(F.col(f"`{f.name}`"), f.dataType).alias("value"))
        for f in table.schema.fields
    ]
    return table.select(F.inline(F.array(*cells)))


def profile_columns(table: DataFrame, domain_limit: int | None = None) -> DataFrame:
    """One row per column: type, counts, lengths, and the domain where it is small.

    One scan. Values are counted per (column, value) before anything is shuffled. A column of
    more than `domain_limit` distinct values has no domain. Up to that number the domain is
    exact: it comes from a frequent-items sketch with room for many times as many.
    """
    limit = DOMAIN_LIMIT if domain_limit is None else domain_limit
    types = F.create_map(
        *[x for f in table.schema.fields for x in (F.lit(f.name), F.lit(declared_type(f.dataType)))]
    )
    order = F.create_map(*[x for i, c in enumerate(table.columns) for x in (F.lit(c), F.lit(i))])
    counted = (
        melt(table)
        .select(
            "column",
            F.length("value").alias("length"),
            "value",
        )
        .groupBy("column", "value", "length")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sketch = F.call_function("approx_top_k", F.col("value"), F.lit(limit + 1), F.lit(max(1024, 20 * limit)))
    values = F.filter(F.transform("sketch", lambda item: item["item"]), lambda v: v.isNotNull())
    few = F.col("distinct_values").between(1, limit) & (F.size(values) == F.col("distinct_values"))
    return (
        counted.groupBy("column")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
            F.min("length").alias("min_length"),
            F.max("length").alias("max_length"),
            sketch.alias("sketch"),
        )
        .select(
            F.element_at(order, F.col("column")).alias("position"),
            "column",
            F.element_at(types, F.col("column")).alias("type"),
            "rows",
            "nulls",
            "distinct_values",
            "min_length",
            "max_length",
            F.when(few, F.array_join(F.array_sort(values), "|")).alias("domain"),
        )
    )


class OverlayError(Exception):
    """The curated half names columns that the table does not have."""


def check_curated_keys(table: DataFrame, keys: list[str]) -> None:
    missing = [k for k in keys if k not in table.columns]
    if missing:
        raise OverlayError(f"curated keys name columns that are not there: {missing}")


def overlay_descriptor(profile: DataFrame, overrides: DataFrame) -> DataFrame:
    """The profile as field declarations, with every curated value put in its place.

    `overrides` holds one row per column with any of type, description, pattern,
    min_length, max_length, required; NULL leaves what the profile found.
    """
    o = overrides.select(*[F.col(c).alias(c if c == "column" else f"_{c}") for c in overrides.columns])
    return profile.join(o, "column", "left").select(
        "position",
        "column",
        F.coalesce("_type", "type").alias("type"),
        F.col("_description").alias("description"),
        F.col("_pattern").alias("pattern"),
        F.coalesce("_min_length", "min_length").alias("min_length"),
        F.coalesce("_max_length", "max_length").alias("max_length"),
        F.coalesce(F.col("_required"), F.lit(False)).alias("required"),
        (F.col("_type").isNotNull() | F.col("_min_length").isNotNull() | F.col("_max_length").isNotNull()
         | F.col("_pattern").isNotNull() | F.col("_description").isNotNull()
         | F.col("_required").isNotNull()).alias("curated"),
    )


# Formats a column of text may have, the narrowest first: its first letters say which, and every value must fit.
FORMATS = {
    "integer": r"[+-]?[0-9]+",
    "number": r"[+-]?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "datetime": r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?",
    "uri": r"[A-Za-z][A-Za-z0-9+.\-]*://[^\s]+",
    "code": r"[A-Z0-9]+([\-_#][A-Z0-9]+)*",
    "word": r"[^\s]+",
    "line": r"[^\n\r]*",
}


def describe_columns(table: DataFrame, enums: dict[str, list[str]] | None = None, domain_limit: int | None = None) -> DataFrame:
    """What a descriptor says of each column beyond its type: format, domain, and how the domain meets a declared enum.

    `format` is the first of FORMATS that every value fits, `text` if none does, NULL without values. `domain` lists the values
    of a column of up to `domain_limit` distinct ones, exactly and apart, whatever they hold; `open` says that the data do not settle
    the domain: it is longer than listed, or a declared enum names values that do not occur. `outside` are listed values that the
    enum lacks, `unseen` declared ones that do not occur. One scan: values are counted before they are shuffled, and
    a fixed number of flags and a list of at most `domain_limit` + 1 values is all that is kept for a column.
    """
    limit = DOMAIN_LIMIT if domain_limit is None else domain_limit
    counted = melt(table).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    fits = [F.min(F.col("value").rlike(rf"\A(?:{p})\z")).alias(f"fits_{name}") for name, p in FORMATS.items()]
    sketch = F.call_function("approx_top_k", F.col("value"), F.lit(limit + 1), F.lit(max(1024, 20 * limit)))
    values = F.filter(F.transform("sketch", lambda item: item["item"]), lambda v: v.isNotNull())
    told = counted.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("rows"),
        F.count("value").alias("distinct_values"), *fits, sketch.alias("sketch"),
    )
    kind = F.lit(None).cast("string")
    for name in reversed(FORMATS):
        kind = F.when(F.col(f"fits_{name}"), name).otherwise(kind)
    few = (F.col("distinct_values") <= limit) & (F.size(values) == F.col("distinct_values"))
    lists = [(c, list(v)) for c, v in (enums or {}).items()]
    declared = table.sparkSession.createDataFrame(lists, "column string, enum array<string>")
    order = table.sparkSession.createDataFrame(list(enumerate(table.columns)), "position int, column string")
    met = order.join(told, "column", "left").join(declared, "column", "left").withColumn("domain", F.when(few, F.array_sort(values)))
    unseen = F.array_sort(F.array_except("enum", "domain"))
    return met.select(
        "position", "column",
        F.when(F.col("distinct_values") > 0, F.coalesce(kind, F.lit("text"))).alias("format"),
        F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
        F.coalesce("domain", F.when(F.coalesce("distinct_values", F.lit(0)) == 0, F.array().cast("array<string>"))).alias("domain"),
        (F.col("domain").isNull() | (F.coalesce(F.size(unseen), F.lit(0)) > 0)).alias("open"),
        F.array_sort(F.array_except("domain", "enum")).alias("outside"), unseen.alias("unseen"),
    )
