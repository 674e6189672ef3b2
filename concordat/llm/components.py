"""Connected components of a table of links, with DataFrame operations only.

Alternating large and small stars: every round each node tells its larger neighbours, then its
smaller ones, of the smallest node it knows. Both steps are a minimum by key, which is partial
on the map side, and a join of the links with one row per key, which adaptive execution can
split where a node has very many links. Rounds grow with the logarithm of the longest path.
Each round is written to the shared folder, so neither lineage nor driver memory grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def connected(links: DataFrame, first: str, second: str) -> DataFrame:
    """(node, component) for every node of `links`; the component is its smallest node.

    Rows with a null end are no links. A link of a node to itself names the node only. An
    empty table gives an empty table.
    """
    ends = links.select(F.col(first).alias("a"), F.col(second).alias("b")).where("a is not null and b is not null")
    pairs = ends.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    stars = written(pairs, "links")
    alone = stars.where("high = low").select(F.col("high").alias("node"), F.col("low").alias("component"))
    stars = stars.where("high <> low")
    seen = None
    while (now := _digest(stars)) != seen and now[0]:
        seen = now
        both = stars.select(F.col("high").alias("x"), F.col("low").alias("y")).unionAll(stars.select("low", "high"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = (
            both.where("y > x").join(least, "x").select(F.col("y").alias("high"), F.col("m").alias("low")).distinct()
        )
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = (
            large.join(least, "high")
            .select(F.col("low").alias("high"), F.col("m").alias("low"))
            .where("high <> low")
            .unionAll(least.select("high", F.col("m").alias("low")))
        )
        stars = written(small.distinct(), "stars")
    leaves = stars.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = stars.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    found = leaves.unionAll(roots)
    return found.unionAll(alone.join(found, "node", "left_anti"))
