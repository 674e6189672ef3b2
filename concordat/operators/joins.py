"""Declared joins, planned from descriptors and run, all of them in one pass over each table.

A declaration names columns, not tables: the left table is the one resource of the package that
declares them all, the right one the only resource of any package under the name it refers to.
What does not resolve is a finding of the plan; running a plan with findings is an error.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import unsized
from ..sources import descriptors
from . import contract
from .coverage import COMPARISONS, Join, UnusableJoin

PLANNED = ["package", "join", "resource", "target", "owner", "compare_as"]
COVERAGE = "rows bigint, matched bigint"
SCOPE = "field string, equals string"


def _malformed(write: bool) -> Column:
    """The first thing wrong with a declaration by itself, or NULL."""
    ours, theirs = F.size("fields"), F.size("target_fields")
    scope, stated = F.col("where_json"), F.col("coverage_json")
    keys = lambda raw: F.array_sort(F.json_object_keys(raw))
    names = lambda *x: F.array(*map(F.lit, x))
    counts = F.from_json(stated, COVERAGE)
    whole = [F.coalesce(F.get_json_object(stated, f"$.{k}"), F.lit("")).rlike(r"\A[0-9]+\z") for k in ("matched", "rows")]
    found = (
        F.when((ours == 0) | (theirs == 0), "declares no fields on one side")
        .when(ours != theirs, F.concat(F.lit("maps "), ours.cast("string"), F.lit(" field(s) onto "), theirs.cast("string")))
        .when(F.col("target").isNull(), "refers to no resource")
        .when(~F.col("compare_as").isin(*COMPARISONS), F.concat(F.lit("has no comparison "), F.col("compare_as")))
        .when(scope.isNotNull() & ~keys(scope).eqNullSafe(names("equals", "field")), "its scope is not one field and one value")
    )
    if write:
        return found
    return (
        found.when(~keys(stated).eqNullSafe(names("matched", "rows")), "its coverage is not rows and matched")
        .when(~(whole[0] & whole[1]), "its coverage is not two counts")
        .when(counts.matched > counts.rows, "its coverage has more matched rows than rows")
    )


def plan_joins(parsed: DataFrame, write: bool = False) -> DataFrame:
    """One row per declared join: the tables it runs on, or what keeps it from running.

    `parsed` is as `descriptors.parse_descriptors` returns it. `write`: coverage is about to be measured, and need not
    be stated. Declarations meet one row per package, and one per resource name.
    """
    fields = descriptors.contract_fields(parsed).groupBy("package", "resource").agg(F.collect_set("field").alias("has"))
    packages = fields.groupBy("package").agg(F.collect_list(F.struct("resource", "has")).alias("tables"))
    # A name that several resources of one package carry is ambiguous too: count declarations, not packages. What the
    # only declaration of a name has is all that is looked at, so the least of them will do.
    names = F.when(F.col("package").isNotNull(), F.col("schema.fields.name"))
    index = descriptors.contract_resources(parsed).groupBy(F.col("resource").alias("target")).agg(
        F.count(F.lit(1)).alias("declarations"), F.min("package").alias("owner"), F.min(names).alias("there")
    )
    joins = descriptors.contract_joins(parsed).withColumns(
        {"wrong": _malformed(write), "scope": F.from_json("where_json", SCOPE)}
    )
    joins = joins.withColumn("needed", F.array_compact(F.array_append("fields", F.col("scope.field"))))
    met = joins.join(unsized(packages), "package", "left").join(unsized(index), "target", "left")
    holding = F.filter("tables", lambda t: F.size(F.array_except("needed", t["has"])) == 0)
    met = met.withColumn("lefts", F.array_sort(F.coalesce(F.transform(holding, lambda t: t["resource"]), F.array().cast("array<string>"))))
    undeclared = F.array_except("target_fields", F.coalesce("there", F.array().cast("array<string>")))
    needed = F.array_join("needed", ", ")
    finding = F.coalesce(
        "wrong",
        F.when(F.size("lefts") == 0, F.concat(F.lit("no resource of the package declares "), needed))
        .when(F.size("lefts") > 1, F.concat(needed, F.lit(" is declared by "), F.array_join("lefts", " and ")))
        .when(F.col("declarations").isNull(), F.concat(F.lit("refers to "), F.col("target"), F.lit(", which no package declares")))
        .when(F.col("declarations") > 1, F.concat(F.lit("refers to "), F.col("target"), F.lit(", of which there are "), F.col("declarations").cast("string")))
        .when(F.size(undeclared) > 0, F.concat(F.lit("refers to "), F.col("target"), F.lit("."), undeclared[0], F.lit(", which is not declared"))),
    )
    runs = finding.isNull()
    return met.select(
        "package", "join", F.when(F.size("lefts") == 1, F.get("lefts", F.lit(0))).alias("resource"), "target",
        F.when(F.col("declarations") == 1, F.col("owner")).alias("owner"), "compare_as", finding.alias("finding"),
        "fields", "target_fields", "scope", F.when(runs, F.from_json("coverage_json", COVERAGE)).alias("stated"),
    )


def _common(left: T.DataType, right: T.DataType) -> str | None:
    """The type in which two columns are compared as stored; None: as they are."""
    if left == right:
        return None
    for one, other in ((left, right), (right, left)):
        if isinstance(one, T.StringType):
            return other.simpleString()
    numbers = [isinstance(x, T.NumericType) for x in (left, right)]
    if not all(numbers):
        return "string"
    exact = [isinstance(x, T.IntegralType) for x in (left, right)]
    return "bigint" if all(exact) else "double"


def _key(table: DataFrame, columns: Iterable[str], types: Iterable[str | None]) -> Column:
    """The columns as one array of texts; NULL where any is NULL, as it then equals nothing."""
    parts = []
    for column, kind in zip(columns, types):
        value = F.col(f"`{column}`")
        parts.append((value if kind is None else value.try_cast(kind)).cast("string"))
    missing = F.lit(False)
    for part in parts:
        missing = missing | part.isNull()
    return F.when(~missing, F.array(*parts))


def measure_joins(declared: list[tuple[Join, str, DataFrame, str, DataFrame]]) -> DataFrame:
    """(number, rows, matched) of each join: left rows in its scope, and those that the right side has a key for.

    Each entry is (join, left name, left table, right name, right table). All joins of a left table are taken from one
    scan of it, and all of a right one, too. Keys are counted before they are shuffled and meet distinct keys, so a
    hot key is one row a task, and joins share one shuffle.
    """
    left_of: dict[str, list[Column]] = {}
    right_of: dict[str, list[Column]] = {}
    tables: dict[tuple[str, str], DataFrame] = {}
    for number, (join, left_name, left, right_name, right) in enumerate(declared):
        for side, table, columns in (("left", left, join.fields + ((join.where[0],) if join.where else ())), ("right", right, join.target_fields)):
            if gone := [c for c in columns if c not in table.columns]:
                raise UnusableJoin(join.name, [f"the {side} table has no column {c}" for c in gone])
        kinds = [
            None if join.compare_as == "text" else _common(left.schema[a].dataType, right.schema[b].dataType)
            for a, b in zip(join.fields, join.target_fields)
        ]
        inside = F.col(f"`{join.where[0]}`").cast("string").eqNullSafe(F.lit(join.where[1])) if join.where else F.lit(True)
        mine, theirs = _key(left, join.fields, kinds), _key(right, join.target_fields, kinds)
        left_of.setdefault(left_name, []).append(F.when(inside, F.struct(F.lit(number).alias("number"), mine.alias("key"))))
        right_of.setdefault(right_name, []).append(F.when(theirs.isNotNull(), F.struct(F.lit(number).alias("number"), theirs.alias("key"))))
        tables["left", left_name], tables["right", right_name] = left, right

    def taken(side: str, of: dict[str, list[Column]]) -> DataFrame:
        parts = [tables[side, name].select(F.explode(F.array_compact(F.array(*keys))).alias("x")).select("x.*") for name, keys in of.items()]
        return contract.union_all(parts)

    counted = taken("left", left_of).groupBy("number", "key").agg(F.count(F.lit(1)).alias("n"))
    known = taken("right", right_of).distinct().withColumn("hit", F.lit(True))
    met = counted.alias("l").join(
        known.alias("r"), (F.col("l.number") == F.col("r.number")) & (F.col("l.key") == F.col("r.key")), "left"
    )
    found = met.groupBy(F.col("l.number").alias("number")).agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("matched")
    )
    spark = found.sparkSession
    every = spark.range(len(declared)).select(F.col("id").cast("int").alias("number"))
    return every.join(found, "number", "left").select("number", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("matched", F.lit(0)).alias("matched"))


def run_joins(plan: DataFrame, tables: dict[tuple[str, str], DataFrame], local: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every join of `plan` measured, beside what is stated: package, join, resource, target, owner, compare_as,
    declared_rows, declared_matched, rows, matched, agrees (NULL where nothing is stated).

    `tables` are published ones by (package, resource); `local` redirects a resource name to a table that is not
    published yet. A plan with findings raises them all. Declarations pass through the driver, one row a join.
    """
    rows = plan.orderBy("package", "join").collect()
    if broken := [f"{r.package}: {r.join} {r.finding}" for r in rows if r.finding]:
        raise UnusableJoin("declared joins", broken)
    declared, spark = [], plan.sparkSession

    def side(package: str, resource: str) -> tuple[str, DataFrame]:
        if local and resource in local:
            return f"local {resource}", local[resource]
        if (package, resource) not in tables:
            raise UnusableJoin(resource, [f"there is no table of {package}"])
        return f"{package} {resource}", tables[package, resource]

    for r in rows:
        where = (r.scope.field, r.scope.equals) if r.scope else None
        join = Join(r.join, tuple(r.fields), r.target, tuple(r.target_fields), r.compare_as, where)
        declared.append((join, *side(r.package, r.resource), *side(r.owner, r.target)))
    numbered = [(n, *[r[c] for c in PLANNED], *((r.stated.rows, r.stated.matched) if r.stated else (None, None))) for n, r in enumerate(rows)]
    names = ", ".join(f"`{c}` string" for c in PLANNED)
    said = spark.createDataFrame(numbered, f"number int, {names}, declared_rows bigint, declared_matched bigint")
    if not declared:
        return said.drop("number").selectExpr("*", "declared_rows as rows", "declared_matched as matched", "true as agrees")
    agrees = (F.col("rows") == F.col("declared_rows")) & (F.col("matched") == F.col("declared_matched"))
    return said.join(measure_joins(declared), "number").withColumn("agrees", agrees).drop("number")


def join_violations(measured: DataFrame) -> DataFrame:
    """What is stated and not so, as findings of the audit's list."""
    wrong = measured.where("not agrees").withColumns({"field": F.col("join"), "rule": F.lit("x-joins.coverage")})
    number = lambda c: F.format_number(c, 0)
    return contract.violations(
        wrong, "states ", number("declared_matched"), " of ", number("declared_rows"), " row(s) matched; there are ",
        number("matched"), " of ", number("rows"),
    )


def with_coverage(document: dict, measured: DataFrame) -> dict:
    """The descriptor with what was measured as its joins' coverage, whatever they stated."""
    found = {r.join: {"matched": r.matched, "rows": r.rows} for r in measured.where(F.col("package") == document["name"]).collect()}
    out = json.loads(json.dumps(document))
    for declared in (out.get("x-joins") or {}).get("joins") or []:
        name = declared.get("name") or (declared.get("reference") or {}).get("resource")
        if name in found:
            declared["coverage"] = found[name]
    return out


def documents_frame(spark: SparkSession, documents: list[dict]) -> DataFrame:
    """Descriptors as the parsed table that `plan_joins` reads."""
    return descriptors.parse_descriptors(spark.createDataFrame([(json.dumps(d),) for d in documents], "text string"), "text")
