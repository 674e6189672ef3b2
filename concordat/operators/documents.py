"""Where two JSON documents disagree, by JSON pointer.

Documents are variants, compared level by level: what is alike so far is taken apart one level
further, in the row it stands in, so documents are shuffled once, to meet each other. What lies
beneath a disagreement is never looked at, nor what is written alike in both. Some levels are taken in one
pass over the documents; only what is still open then is staged and gone over again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

# Levels taken apart in one pass.
LEVELS = 4
FINDING = ["pointer", "finding", "expected", "actual"]


def _kind(text: Column) -> Column:
    """The JSON kind of a node's text, as `to_json` writes it; whole and broken numbers are one kind."""
    first = F.substring(text, 1, 1)
    return (
        F.when(text == "", "unreadable").when(first == "{", "object").when(first == "[", "array").when(first == '"', "string")
        .when(first.isin("t", "f"), "boolean").when(first == "n", "null").when(text.isNotNull(), "number")
    )


def _items(node: Column) -> Column:
    return F.try_variant_get(node, "$", "array<variant>")


def _members(node: Column) -> Column:
    return F.try_variant_get(node, "$", "map<string,variant>")


def _same_number(a: Column, b: Column) -> Column:
    """Numbers are equal if their values are, whichever way they are written."""
    number = F.try_variant_get(a, "$", "double") == F.try_variant_get(b, "$", "double")
    whole = (F.schema_of_variant(a) == "BIGINT") & (F.schema_of_variant(b) == "BIGINT")
    return ~whole & F.coalesce(number, F.lit(False))


def _judged(nodes: DataFrame, key: str) -> DataFrame:
    """Nodes (pointer, a, b, and their texts) that are not alike: with a finding, or without one if still open.

    A text is NULL where the node is missing, and empty where it is unreadable. Nodes that already have a finding keep it.
    """
    told = nodes.withColumns({"kind_a": _kind(F.col("text_a")), "kind_b": _kind(F.col("text_b"))})
    kind, deep = F.col("kind_a"), F.col("kind_a").isin("array", "object")
    sizes = [F.when(kind == "array", F.size(_items(F.col(side)))) for side in ("a", "b")]
    finding = (
        F.when((F.col("kind_a") == "unreadable") | (F.col("kind_b") == "unreadable"), "unreadable")
        .when(kind.isNull(), "unexpected")
        .when(F.col("kind_b").isNull(), "absent")
        .when(kind != F.col("kind_b"), "kind")
        .when((kind == "array") & (F.col("size_a") != F.col("size_b")), "length")
        .when(~deep & ~((kind == "number") & _same_number(F.col("a"), F.col("b"))), "value")
    )
    told = told.withColumns({"size_a": sizes[0], "size_b": sizes[1]}).withColumn("new", finding)

    def shown(side: str) -> Column:
        new = F.col("new")
        return F.when(new == "length", F.col(f"size_{side}").cast("string")).when(new == "value", F.col(f"text_{side}")).otherwise(F.col(f"kind_{side}"))

    def either(name: str, value: Column) -> Column:
        return F.when(F.col("finding").isNotNull(), F.col(name)).otherwise(value).alias(name)

    is_open = F.col("finding").isNull() & F.col("new").isNull()
    row = F.struct(
        either("finding", F.col("new")), either("expected", shown("a")), either("actual", shown("b")),
        F.when(is_open, kind).alias("kind"), F.when(is_open, F.col("a")).alias("a"), F.when(is_open, F.col("b")).alias("b"),
    )
    # Behind a generator, so that the filter does not work the verdict out a second time.
    return told.select(key, "pointer", F.inline(F.array(row))).where("finding is not null or kind in ('array', 'object')")


def _beneath(judged: DataFrame, key: str) -> DataFrame:
    """The children of open nodes that are not written alike, each with its counterpart; findings as they are."""
    a, b = F.col("a"), F.col("b")
    pair = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    node = lambda child, p: F.struct(
        child.alias("child"), p["a"].alias("a"), p["b"].alias("b"), F.to_json(p["a"]).alias("text_a"), F.to_json(p["b"]).alias("text_b")
    )
    members = F.map_entries(F.map_zip_with(_members(a), _members(b), lambda _, x, y: pair(x, y)))
    items = F.zip_with(_items(a), _items(b), pair)
    nodes = F.when(F.col("kind") == "object", F.transform(members, lambda m: node(m["key"], m["value"]))).otherwise(
        F.transform(items, lambda p, i: node(i.cast("string"), p))
    )
    unlike = F.filter(nodes, lambda n: ~n["text_a"].eqNullSafe(n["text_b"]))
    itself = "array(struct(string(null) as child, cast(null as variant) as a, cast(null as variant) as b, string(null) as text_a, string(null) as text_b))"
    kept = F.when(F.col("finding").isNull(), unlike).otherwise(F.expr(itself))
    step = F.replace(F.replace(F.col("child"), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    return judged.select(key, *FINDING, F.inline(kept)).withColumn(
        "pointer", F.when(F.col("finding").isNull(), F.concat("pointer", F.lit("/"), step)).otherwise(F.col("pointer"))
    )


def document_diff(expected: DataFrame, actual: DataFrame, key: str, column: str) -> DataFrame:
    """One row per topmost node at which two documents with the same key disagree.

    Lists of unlike length and nodes of unlike kind are one disagreement each; what lies
    beneath them is not compared. A text that is no JSON, or names a member twice, is a finding at the
    root, never an error; a document without a counterpart is absent or unexpected whole. Pointers escape `~` and `/`
    as the standard says; the root is `/`.
    """
    e = expected.select(key, F.col(column).alias("e"))
    o = actual.select(key, F.col(column).alias("o"))
    met = e.join(o, key, "full").select(key, "e", "o", F.try_parse_json("e").alias("a"), F.try_parse_json("o").alias("b"))
    text = lambda node, told: F.coalesce(F.to_json(node), F.when(F.col(told).isNotNull(), ""))
    root = F.struct("a", "b", text("a", "e").alias("text_a"), text("b", "o").alias("text_b"))
    none = F.lit(None).cast("string")
    nodes = met.select(key, F.lit("").alias("pointer"), *[none.alias(c) for c in FINDING[1:]], F.inline(F.array(root))).where(
        "not text_a <=> text_b or text_a = ''"
    )
    found = []
    while True:
        judged = _judged(nodes, key)
        for _ in range(LEVELS - 1):
            judged = _judged(_beneath(judged, key), key)
        level = staged(judged, "documents")
        found.append(level.where("finding is not null").select(key, *FINDING))
        rest = level.where("finding is null")
        if rest.isEmpty():
            break
        nodes = _beneath(rest, key)
    pointer = F.when(F.col("pointer") == "", "/").otherwise(F.col("pointer"))
    return reduce(DataFrame.unionByName, found).withColumn("pointer", pointer)
