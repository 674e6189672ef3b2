"""Which finished run produced an object together with its descriptor.

Reasons are ordered from the specific to the general: a run that never reached the step
that writes the descriptor also failed as a whole, and the step is what helps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest_form(raw: Column) -> Column:
    """A recorded hash in the form `sha256:<hex>`; empty where none is recorded."""
    text = F.coalesce(raw, F.lit(""))
    return F.when(text.startswith("sha256:") | (text == ""), text).otherwise(F.concat(F.lit("sha256:"), text))


def reached(step: Column) -> Column:
    """A step got there if it ran, or was skipped for a reason that is on record."""
    state = step["status"]["state"]
    skipped = (state == "skipped") & step["status"]["skip_reason"].isNotNull()
    return F.coalesce((state == "success") | skipped, F.lit(False))


def step_reached(name: Column) -> Column:
    """Whether the step of this name, in the record at hand, got there."""
    return F.exists("steps", lambda s: s["name"].eqNullSafe(name) & reached(s))


def run_claims(runs: DataFrame, descriptor_path: str) -> DataFrame:
    """One row per readable run and digest of a file that one of its steps wrote.

    A file that a run only read, or whose step it never reached, is no claim. The record
    holds its own steps, so everything is settled within the row. `flaw` is what is wrong
    with the run itself; `described_hash` is still to be held to the object's descriptor.
    """
    made = F.filter(
        "assets",
        lambda a: (a["kind"] == "file") & a["produced_by"].isNotNull() & step_reached(a["produced_by"]),
    )
    described = F.get(
        F.filter("assets", lambda a: (a["kind"] == "file") & (a["path"] == descriptor_path)), F.lit(0)
    )
    flaw = F.when(F.col("d").isNull(), "records no descriptor").when(
        ~step_reached(F.col("d.produced_by")), "never reached the step that writes the descriptor"
    )
    return (
        runs.where(F.col("error").isNull())
        .withColumn("d", described)
        .select(
            "source",
            "run_id",
            "started_at",
            "outcome",
            flaw.alias("flaw"),
            digest_form(F.col("d.content_hash")).alias("described_hash"),
            F.explode(F.array_distinct(F.transform(made, lambda a: digest_form(a["content_hash"])))).alias("hash"),
        )
        .where(F.col("hash") != "")
    )


def run_provenance(runs: DataFrame, objects: DataFrame, descriptor_path: str) -> DataFrame:
    """For each object: the newest run that licenses it, or why none does.

    `objects` holds object, hash and descriptor_hash. Runs meet objects on the digest of
    the bytes, never on a path: a path says where a file was, a digest what it holds. An
    object without a descriptor digest is licensed by no run.
    Runs that say the same about the same bytes are reduced to the newest of them before
    they meet an object, so bytes that very many runs claim are a few rows.
    """
    newest = F.max(F.struct("started_at", "source", "run_id")).alias("newest")
    claims = (
        run_claims(runs, descriptor_path)
        .groupBy("hash", "described_hash", "flaw", "outcome")
        .agg(F.count(F.lit(1)).alias("n"), newest)
    )
    refusal = (
        F.when(F.col("flaw").isNotNull(), F.col("flaw"))
        .when(~F.col("described_hash").eqNullSafe(F.col("descriptor_hash")), "wrote another descriptor")
        .when(F.col("outcome") != "success", "did not finish")
    )
    met = objects.join(claims, "hash", "left").withColumn("refusal", refusal)
    licensed = F.col("n").isNotNull() & F.col("refusal").isNull()
    judged = met.groupBy("object").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("claimants"),
        F.coalesce(F.sum(F.when(licensed, F.col("n"))), F.lit(0)).alias("licensing"),
        F.max(F.when(licensed, F.col("newest"))).alias("yes"),
        F.max(F.when(F.col("refusal").isNotNull(), F.struct("newest", "refusal"))).alias("no"),
    )
    why = F.when(F.col("claimants") == 0, "no run produced these bytes").when(
        F.col("licensing") == 0, F.col("no.refusal")
    )
    return judged.select(
        "object", "claimants", "licensing", F.col("yes.run_id").alias("run_id"), why.alias("refusal")
    )


# The rungs of refusal, from the specific to the general.
RUNGS = ["descriptor", "step", "digest", "outcome"]


def step_said(name: Column) -> Column:
    """What the record says about the step of this name."""
    status = F.get(F.filter("steps", lambda s: s["name"].eqNullSafe(name)), F.lit(0))["status"]
    return (
        F.when(status["state"].isNull(), "is not on record")
        .when((status["state"] == "skipped") & status["skip_reason"].isNull(), "was skipped and no reason is given")
        .when(status["state"] == "skipped", F.concat(F.lit("was skipped: "), status["skip_reason"]))
        .otherwise(F.concat(F.lit("is "), status["state"]))
    )


def claimant_reasons(runs: DataFrame, objects: DataFrame, descriptor_path: str) -> DataFrame:
    """One row per object and run that claims its bytes: the first rung the run fails on, and why; none where it licenses.

    The rungs are tried in order: the record ties no descriptor to the bytes, the step that writes it never
    got there, the descriptor it wrote is another, the run did not finish. An object that no run claims has one row without a run.
    """
    descriptor = F.get(F.filter("assets", lambda a: (a["kind"] == "file") & (a["path"] == descriptor_path)), F.lit(0))
    made = F.filter("assets", lambda a: (a["kind"] == "file") & a["produced_by"].isNotNull() & step_reached(a["produced_by"]))
    failed = F.transform(F.filter("steps", lambda s: s["status"]["state"] == "failed"), lambda s: s["name"])
    claims = (
        runs.where(F.col("error").isNull())
        .withColumn("d", descriptor)
        .select(
            "source", "run_id", "started_at", "outcome",
            F.col("d").isNull().alias("untied"),
            (~step_reached(F.col("d.produced_by"))).alias("unreached"),
            F.concat(F.coalesce("d.produced_by", F.lit("no step")), F.lit(" "), step_said(F.col("d.produced_by"))).alias("said"),
            digest_form(F.col("d.content_hash")).alias("wrote"),
            F.array_join(F.array_sort(failed), ", ").alias("failed"),
            F.explode(F.array_distinct(F.transform(made, lambda a: digest_form(a["content_hash"])))).alias("hash"),
        )
        .where(F.col("hash") != "")
    )
    met = objects.join(claims, "hash", "left")
    no_run = F.col("run_id").isNull()
    differs = ~F.col("wrote").eqNullSafe(F.col("descriptor_hash"))
    rung = (
        F.when(no_run, None).when(F.col("untied"), RUNGS[0]).when(F.col("unreached"), RUNGS[1]).when(differs, RUNGS[2])
        .when(~F.col("outcome").eqNullSafe("success"), RUNGS[3])
    )
    why = (
        F.when(no_run, "no run produced these bytes")
        .when(F.col("rung") == RUNGS[0], "records no descriptor")
        .when(F.col("rung") == RUNGS[1], F.col("said"))
        .when(F.col("rung") == RUNGS[2], F.concat(F.lit("wrote "), F.substring("wrote", 8, 12), F.lit(", the object has "), F.substring("descriptor_hash", 8, 12)))
        .when(F.col("rung") == RUNGS[3], F.concat(
            F.lit("ended as "), F.coalesce("outcome", F.lit("nothing")), F.when(F.col("failed") == "", "").otherwise(F.concat(F.lit("; failed: "), F.col("failed")))))
    )
    return met.withColumn("rung", rung).select("object", "run_id", "started_at", "source", "rung", why.alias("reason"))


def refusals(reasons: DataFrame) -> DataFrame:
    """One answer per object, from `claimant_reasons`: whether a run licenses it; if none does, each reason with how many
    runs give it and the newest that does, newest first.

    Equal reasons are counted before objects meet them, so bytes that very many runs claim fold to a few rows.
    """
    licensed = F.col("run_id").isNotNull() & F.col("reason").isNull()
    per = reasons.groupBy("object", "reason").agg(
        F.count("run_id").alias("runs"), F.max(F.struct("started_at", "source", "run_id")).alias("newest"), F.max(licensed).alias("licensed")
    )
    told = F.struct(F.col("newest.started_at").alias("at"), F.col("newest.source").alias("source"), "reason", "runs", F.col("newest.run_id").alias("run_id"))
    folded = per.groupBy("object").agg(
        F.max("licensed").alias("licensed"), F.sum("runs").alias("claimants"),
        F.reverse(F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), told)))).alias("told"),
    )
    line = F.transform("told", lambda t: F.when(t["run_id"].isNull(), t["reason"]).otherwise(
        F.concat(t["run_id"], F.lit(" ("), t["runs"].cast("string"), F.lit(") "), t["reason"])))
    return folded.select("object", "licensed", "claimants", F.when(~F.col("licensed"), F.array_join(line, "; ")).alias("refusal"))
