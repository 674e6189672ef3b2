"""Reasons of runs, registry states over time, and column descriptions, on cases of each kind."""

import json

from concordat.operators import profile, provenance, registry
from concordat.sources.runs import parse_runs


def run(run_id, day, steps, descriptor="sha256:d1", writer="describe", outcome="success", made="o1"):
    assets = [{"kind": "file", "path": "out", "content_hash": made, "produced_by": "build"}]
    if descriptor:
        assets.append({"kind": "file", "path": "d.json", "content_hash": descriptor, "produced_by": writer})
    listed = [{"name": n, "status": {"state": s, "skip_reason": r}} for n, s, r in (("build", "success", None), *steps)]
    return json.dumps({"contract_version": "b4/1", "run": {"run_id": run_id, "started_at": day, "outcome": outcome}, "assets": assets, "steps": listed})


def told(spark, *records, version=None):
    frame = spark.createDataFrame([(r, f"runs/{i}") for i, r in enumerate(records)], "text string, path string")
    objects = spark.createDataFrame([("x", "sha256:o1", "sha256:d1"), ("lost", "sha256:zz", "sha256:d1")], "object string, hash string, descriptor_hash string")
    return provenance.claimant_reasons(parse_runs(frame, "text", "path"), objects, "d.json")


def test_each_rung_and_its_words(spark):
    fine = [("describe", "success", None)]
    found = told(
        spark,
        run("r0", "1", fine, descriptor=None),
        run("r1", "2", [("describe", "skipped", None)]),
        run("r2", "3", [("describe", "failed", None)]),
        run("r3", "4", []),
        run("r4", "5", fine, descriptor="sha256:other0123456789"),
        run("r5", "6", [*fine, ("verify", "failed", None), ("audit", "failed", None)], outcome="partial"),
        run("r6", "7", fine, made="o9"),
    )
    rows = {r.run_id: (r.rung, r.reason) for r in found.where("object = 'x'").collect()}
    assert rows == {
        "r0": ("descriptor", "records no descriptor"),
        "r1": ("step", "describe was skipped and no reason is given"),
        "r2": ("step", "describe is failed"),
        "r3": ("step", "describe is not on record"),
        "r4": ("digest", "wrote other0123456, the object has d1"),
        "r5": ("outcome", "ended as partial; failed: audit, verify"),
    }
    answers = {r.object: r for r in provenance.refusals(found).collect()}
    assert not answers["x"].licensed and answers["x"].claimants == 6
    assert [x.split(" ")[0] for x in answers["x"].refusal.split("; r")] [0] == "r5" and answers["x"].refusal.endswith("r0 (1) records no descriptor")
    assert (answers["lost"].claimants, answers["lost"].refusal) == (0, "no run produced these bytes")


def test_a_later_failure_does_not_take_a_licence_away(spark):
    fine = [("describe", "skipped", "hash_clean")]
    found = told(spark, run("good", "1", fine), run("bad", "2", fine, outcome="partial"))
    answers = {r.object: r for r in provenance.refusals(found).collect()}
    assert answers["x"].licensed and answers["x"].refusal is None


def test_promises_over_time(spark):
    rows = [
        (1, "a", "s", "one", []), (2, "a", "s", "uno", ["one"]), (3, "a", "s", "uno", []),
        (1, "b", "s", "two", None), (2, "b", "s", "zwei", None), (3, "b", "s", "zwei", None),
        (1, "c", "s", "three", None), (3, "c", "s", "three", None),
        (1, "d", "s", "four", None),
        (3, "e", "s", "one", None),
    ]
    states = spark.createDataFrame(rows, "version int, uid string, schema string, name string, aliases array<string>")
    found = sorted((r.rule, r.subject, r.version, r.before, r.after) for r in registry.history_violations(states).na.fill("-").collect())
    assert found == [
        ("address.repointed", "s.one", 3, "a", "e"), ("uid.gone", "c", 2, "s.three", "-"), ("uid.gone", "d", 2, "s.four", "-"),
        ("uid.returned", "c", 3, "1", "s.three"), ("uid.reused", "b", 2, "s.two", "s.zwei")]
    spans = {(r.uid, r.address, r.first_version, r.last_version, r.last_own) for r in registry.address_history(states).collect()}
    assert {("a", "s.one", 1, 2, 1), ("a", "s.uno", 2, 3, 3), ("c", "s.three", 1, 1, 1), ("c", "s.three", 3, 3, 3)} <= spans
    assert registry.history_violations(states.limit(0)).collect() == []


def test_descriptions(spark):
    rows = [("a|b", "12", "2024-01-02", None, "x y"), ("c", "-3", "2024-01-03", None, "x\ny"), ("c", "+4", "2024-02-30", None, "")]
    table = spark.createDataFrame(rows, "v string, n string, d string, gone string, t string")
    got = {r.column: r for r in profile.describe_columns(table, {"v": ["c", "z"], "gone": ["q"]}).collect()}
    assert (got["v"].domain, got["v"].outside, got["v"].unseen, got["v"].open) == (["a|b", "c"], ["a|b"], ["z"], True)
    assert [got[c].format for c in ("v", "n", "d", "gone", "t")] == ["word", "integer", "date", None, "text"]
    assert (got["n"].open, got["n"].outside, got["gone"].domain, got["gone"].open, got["gone"].rows) == (False, None, [], True, 0)
    wide = profile.describe_columns(spark.range(60).selectExpr("cast(id as string) as v"), domain_limit=50).first()
    assert (wide.domain, wide.open, wide.distinct_values) == (None, True, 60)
    assert [r.rows for r in profile.describe_columns(table.limit(0)).collect()] == [0] * 5
