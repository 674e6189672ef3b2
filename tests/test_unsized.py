"""Rows taken out of parsed texts are not broadcast, however small their texts are."""

import json

import pytest

from concordat.operators import contract, joins
from concordat.plans import queries
from concordat.sources import descriptors


@pytest.fixture
def parsed(rows):
    schema = {"fields": [{"name": "key", "type": "integer"}], "foreignKeys": [{"fields": "key", "reference": {"resource": "r0", "fields": "key"}}]}
    declared = {"joins": [{"name": "j", "fields": "key", "reference": {"resource": "r0", "fields": "key"}, "coverage": {"rows": 1, "matched": 1}}]}
    texts = [(json.dumps({"name": f"p{n}", "resources": [{"name": f"r{n}", "schema": schema}], "x-joins": declared}),) for n in range(3)]
    return descriptors.parse_descriptors(rows("text string", *texts), "text")


def broadcasts(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_foreign_keys_are_met_without_a_broadcast(parsed):
    checked = contract.check_foreign_keys(
        descriptors.contract_foreign_keys(parsed), descriptors.contract_fields(parsed), descriptors.contract_resources(parsed)
    )
    assert checked.collect() == [] and broadcasts(checked) == 0


def test_joins_are_planned_without_a_broadcast(parsed):
    planned = joins.plan_joins(parsed)
    assert {(r.package, r.resource, r.owner, r.finding) for r in planned.collect()} == {(f"p{n}", f"r{n}", "p0", None) for n in range(3)}
    assert broadcasts(planned) == 0


def test_types_are_met_without_a_broadcast(parsed, rows):
    physical = rows("package string, resource string, field string, physical string", ("p0", "r0", "key", "string"), ("p1", "r1", "key", "int"))
    checked = contract.check_types(descriptors.contract_fields(parsed), physical)
    assert rows.of(checked, "package", "rule") == [("p0", "type")] and broadcasts(checked) == 0


def test_the_report_of_all_checks_broadcasts_nothing(spark):
    assert broadcasts(queries.registered()["violation_report"](spark, "/root/testdata/sf0.001")) == 0


def test_the_report_of_all_checks_holds_no_plan_of_a_check(spark):
    report = queries.registered()["violation_report"](spark, "/root/testdata/sf0.001")
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1
    assert report.count() == report.select("package", "resource", "rule").distinct().count() > 0
