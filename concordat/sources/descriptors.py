"""Package descriptors (Frictionless Data Package documents) as contract tables.

A descriptor names its resources; a resource states fields, keys and its own bytes; the
package may declare partial joins. The parts whose shape may vary are first kept as raw
JSON, so that a shape no check reads is seen rather than lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import parse_once

SCHEMA = """
name string,
resources array<struct<
  name string, path string, bytes bigint, hash string,
  schema struct<
    fields array<struct<name string, type string, constraints string>>,
    primaryKey string,
    foreignKeys array<struct<fields string, reference struct<resource string, fields string>>>
  >
>>,
`x-joins` struct<joins array<struct<
  name string, fields string, reference struct<resource string, fields string>,
  compareAs string, where string, coverage string
>>>
"""

CONSTRAINTS = """
pattern string, minLength bigint, maxLength bigint, enum array<string>, required boolean
"""

# The constraint keywords a check evaluates.
KNOWN_CONSTRAINTS = ["pattern", "minLength", "maxLength", "enum", "required"]


def parse_descriptors(texts: DataFrame, column: str) -> DataFrame:
    """One parsed descriptor per row of JSON text; `readable` is false where it is not JSON."""
    return texts.select(parse_once(F.col(column), SCHEMA)).select(
        F.col("name").alias("package"),
        "resources",
        F.col("`x-joins`.joins").alias("joins"),
        F.col("resources").isNotNull().alias("readable"),
    )


def descriptor_texts(spark: SparkSession, pattern: str) -> DataFrame:
    """Path and text of each descriptor file."""
    return spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def read_descriptors(spark: SparkSession, pattern: str) -> DataFrame:
    return parse_descriptors(descriptor_texts(spark, pattern), "value")


def one_or_many(raw: Column) -> Column:
    """A name or a list of names, from raw JSON; NULL for any other shape or an empty list."""
    listed = F.from_json(raw, "array<string>")
    every = F.forall(listed, lambda v: v.isNotNull())
    return F.when(raw.startswith("["), F.when((F.size(listed) > 0) & every, listed)).otherwise(
        F.when(raw.rlike(r"\A(?:[{\-0-9]|true\z|false\z|null\z)"), F.lit(None)).otherwise(F.array(raw))
    )


def contract_resources(descriptors: DataFrame) -> DataFrame:
    return descriptors.select("package", F.explode("resources").alias("r")).select(
        "package",
        F.coalesce("r.name", "r.path", F.lit("<unnamed>")).alias("resource"),
        F.col("r.path").alias("path"),
        F.col("r.bytes").alias("bytes"),
        F.col("r.hash").alias("hash"),
        F.col("r.schema").alias("schema"),
    )


def contract_fields(descriptors: DataFrame) -> DataFrame:
    """One row per declared field, with its constraints spread into columns."""
    fields = contract_resources(descriptors).select(
        "package", "resource", F.posexplode("schema.fields").alias("position", "f")
    )
    known = F.array(*[F.lit(k) for k in KNOWN_CONSTRAINTS])
    return fields.select(
        "package",
        "resource",
        "position",
        F.col("f.name").alias("field"),
        F.coalesce("f.type", F.lit("any")).alias("type"),
        F.from_json("f.constraints", CONSTRAINTS).alias("c"),
        F.array_except(F.json_object_keys("f.constraints"), known).alias("unknown"),
    ).select(
        "package",
        "resource",
        "position",
        "field",
        "type",
        F.col("c.pattern").alias("pattern"),
        F.col("c.minLength").alias("min_length"),
        F.col("c.maxLength").alias("max_length"),
        F.col("c.enum").alias("enum"),
        F.coalesce("c.required", F.lit(False)).alias("required"),
        F.coalesce(F.array_join(F.array_sort("unknown"), ","), F.lit("")).alias("unknown_constraints"),
    )


def contract_keys(descriptors: DataFrame) -> DataFrame:
    """One row per declared primary key; `columns` is NULL where the shape is unreadable."""
    return (
        contract_resources(descriptors)
        .where(F.col("schema.primaryKey").isNotNull())
        .select(
            "package",
            "resource",
            F.col("schema.primaryKey").alias("declared"),
            one_or_many(F.col("schema.primaryKey")).alias("columns"),
        )
    )


def contract_foreign_keys(descriptors: DataFrame) -> DataFrame:
    empty = F.array().cast("array<string>")
    return (
        contract_resources(descriptors)
        .select("package", "resource", F.posexplode("schema.foreignKeys").alias("position", "k"))
        .select(
            "package",
            "resource",
            "position",
            F.coalesce(one_or_many(F.col("k.fields")), empty).alias("fields"),
            F.coalesce("k.reference.resource", "resource").alias("target"),
            F.coalesce(one_or_many(F.col("k.reference.fields")), empty).alias("target_fields"),
        )
    )


def contract_joins(descriptors: DataFrame) -> DataFrame:
    """Declared partial joins, with the shapes still to be judged left as raw JSON."""
    empty = F.array().cast("array<string>")
    return descriptors.select("package", F.explode("joins").alias("j")).select(
        "package",
        F.coalesce("j.name", "j.reference.resource", F.lit("<unnamed>")).alias("join"),
        F.coalesce(one_or_many(F.col("j.fields")), empty).alias("fields"),
        F.col("j.reference.resource").alias("target"),
        F.coalesce(one_or_many(F.col("j.reference.fields")), empty).alias("target_fields"),
        F.coalesce("j.compareAs", F.lit("exact")).alias("compare_as"),
        F.col("j.where").alias("where_json"),
        F.col("j.coverage").alias("coverage_json"),
    )


def resource_index(resources: DataFrame) -> DataFrame:
    """Who declares each resource name. More than one declaration cannot be referred to."""
    return resources.groupBy("resource").agg(
        F.count(F.lit(1)).alias("declarations"),
        F.min("package").alias("package"),
        F.max("package").alias("last_package"),
    ).withColumn("ambiguous", F.col("declarations") > 1)
