"""Registry invariants: an id names one dataset for ever, and so does an address."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def registry_invariants(registry: DataFrame) -> DataFrame:
    """Ids given to more than one dataset, and addresses that lead to more than one id.

    Each entry states what its id names, what its own address leads to, and what each of
    its retired ones does; a subject with two answers breaks an invariant.
    """
    address = lambda name: F.concat_ws(".", "schema", name)

    def claim(kind: str, subject: Column, other: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), subject.alias("subject"), other.alias("other"))

    own = address(F.col("name"))
    stated = F.array(claim("uid", F.col("uid"), own), claim("name", own, F.col("uid")))
    retired = F.transform(
        F.coalesce("aliases", F.array().cast("array<string>")), lambda a: claim("alias", address(a), F.col("uid"))
    )
    of_id = F.col("kind") == "uid"
    return (
        registry.select(F.inline(F.concat(stated, retired)))
        .groupBy(of_id.alias("of_id"), "subject")
        .agg(
            F.count_distinct("other").alias("claims"),
            F.min("other").alias("first"),
            F.max("other").alias("last"),
            F.count_if(F.col("kind") == "alias").alias("aliases"),
        )
        .where(F.col("claims") > 1)
        .select(
            F.when(F.col("of_id"), "uid.reused")
            .when(F.col("aliases") > 0, "alias.repointed")
            .otherwise("address.shared")
            .alias("rule"),
            "subject",
            "claims",
            "first",
            "last",
        )
    )


def _addresses(states: DataFrame) -> DataFrame:
    """(version, uid, address, retired): what each id answers to in each state."""
    address = lambda name: F.concat_ws(".", "schema", name)
    own = F.array(F.struct(address(F.col("name")).alias("address"), F.lit(False).alias("retired")))
    old = F.transform(
        F.coalesce("aliases", F.array().cast("array<string>")),
        lambda a: F.struct(address(a).alias("address"), F.lit(True).alias("retired")),
    )
    return states.select("version", "uid", F.inline(F.concat(own, old))).distinct()


def address_history(states: DataFrame) -> DataFrame:
    """When each id answered to each address: one row per unbroken interval of states.

    `states` holds version (a whole number, one up from state to state), uid, schema, name, aliases. An address that
    is given up and taken again has two intervals. Windows hold one row a state.
    """
    held = _addresses(states).groupBy("uid", "address", "version").agg(F.min("retired").alias("retired"))
    run = F.col("version") - F.row_number().over(Window.partitionBy("uid", "address").orderBy("version"))
    return held.withColumn("run", run).groupBy("uid", "address", "run").agg(
        F.min("version").alias("first_version"), F.max("version").alias("last_version"),
        F.max(F.when(~F.col("retired"), F.col("version"))).alias("last_own"),
    ).drop("run")


def history_violations(states: DataFrame) -> DataFrame:
    """What breaks the promises that hold over time: (rule, subject, version, before, after).

    `uid.reused`: an id has another address than in the state before, and does not answer to the old one: it names another dataset.
    `address.repointed`: an address leads to another id than it did in an earlier state. `uid.gone`: an id of a state is not in the next.
    `uid.returned`: an id that was gone is back.
    """
    own = states.select("version", "uid", F.concat_ws(".", "schema", "name").alias("address"), "schema", "aliases")
    by_id = Window.partitionBy("uid").orderBy("version")
    steps = own.groupBy("uid", "version").agg(
        F.min("address").alias("address"),
        F.array_distinct(F.flatten(F.collect_list(F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.concat_ws(".", "schema", a))))).alias("answers"),
    )
    last = states.agg(F.max("version").alias("newest"))
    steps = steps.withColumns({c: F.lag(c.removeprefix("was_")).over(by_id) for c in ("was_version", "was_address")})
    reused = steps.where((F.col("was_address") != F.col("address")) & ~F.array_contains("answers", F.col("was_address")))
    shape = lambda rule, subject, before, after: (
        F.lit(rule).alias("rule"), F.col(subject).alias("subject"), "version", before.alias("before"), after.alias("after"))
    found = [
        reused.select(*shape("uid.reused", "uid", F.col("was_address"), F.col("address"))),
        steps.where(F.col("version") > F.col("was_version") + 1).select(*shape("uid.returned", "uid", F.col("was_version").cast("string"), F.col("address"))),
    ]
    ends = steps.withColumn("next", F.lead("version").over(by_id)).join(last, F.col("version") < F.col("newest"))
    gone = ends.where(F.coalesce(F.col("next") > F.col("version") + 1, F.lit(True)))
    found.append(gone.withColumn("version", F.col("version") + 1).select(*shape("uid.gone", "uid", F.col("address"), F.lit(None).cast("string"))))
    leads = _addresses(states).groupBy("address", "version").agg(F.min("uid").alias("uid"))
    by_address = Window.partitionBy("address").orderBy("version")
    turns = leads.withColumn("was", F.lag("uid").over(by_address)).where("was != uid")
    found.append(turns.select(*shape("address.repointed", "address", F.col("was"), F.col("uid"))))
    return reduce(DataFrame.unionByName, found)
