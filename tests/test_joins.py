"""Declared joins: what the plan finds, and what runs measure."""

import pytest

from concordat.operators import joins
from concordat.operators.coverage import Join, UnusableJoin


def document(name, resources, *declared):
    listed = [{"name": r, "schema": {"fields": [{"name": f} for f in f_]}} for r, f_ in resources]
    return {"name": name, "resources": listed, "x-joins": {"joins": list(declared)}}


def declared(fields="a", resource="right", theirs="id", **more):
    return {"name": "j", "fields": fields, "reference": {"resource": resource, "fields": theirs}, "coverage": {"rows": 1, "matched": 0}, **more}


@pytest.mark.parametrize("changed,finding", [
    ({}, None),
    ({"fields": []}, "declares no fields on one side"),
    ({"theirs": ["id", "b"]}, "maps 1 field(s) onto 2"),
    ({"resource": None}, "refers to no resource"),
    ({"compareAs": "sound"}, "has no comparison sound"),
    ({"where": {"field": "a"}}, "its scope is not one field and one value"),
    ({"where": {"field": "zz", "equals": 1}}, "no resource of the package declares a, zz"),
    ({"coverage": None}, "its coverage is not rows and matched"),
    ({"coverage": {"rows": 1, "matched": 0, "seen": 1}}, "its coverage is not rows and matched"),
    ({"coverage": {"rows": True, "matched": 0}}, "its coverage is not two counts"),
    ({"coverage": {"rows": -1, "matched": 0}}, "its coverage is not two counts"),
    ({"coverage": {"rows": 1, "matched": 2}}, "its coverage has more matched rows than rows"),
    ({"fields": "both"}, "both is declared by left and other"),
    ({"fields": "nowhere"}, "no resource of the package declares nowhere"),
    ({"resource": "ghost"}, "refers to ghost, which no package declares"),
    ({"resource": "twice"}, "refers to twice, of which there are 2"),
    ({"theirs": "gone"}, "refers to right.gone, which is not declared"),
])
def test_plan(spark, changed, finding):
    docs = [
        document("one", [("left", ["a", "both"]), ("other", ["both"]), ("twice", ["id"])], declared(**changed)),
        document("two", [("right", ["id", "b"]), ("twice", ["id"])]),
    ]
    [row] = joins.plan_joins(joins.documents_frame(spark, docs)).collect()
    assert row.finding == finding
    if finding is None:
        assert (row.package, row.resource, row.target, row.owner) == ("one", "left", "right", "two")
    elif "coverage" in finding:
        assert joins.plan_joins(joins.documents_frame(spark, docs), write=True).first().finding is None


def test_runs(spark, rows):
    left = rows("a string, b int, kind string", ("1", 1, "x"), ("1", 2, "x"), ("01", 1, "y"), (None, 1, "x"), ("q", None, "x"))
    right = rows("id int, b bigint", (1, 1), (1, 1), (3, None))
    found = joins.measure_joins([
        (Join("exact", ("a",), "r", ("id",)), "l", left, "r", right),
        (Join("text", ("a",), "r", ("id",), "text"), "l", left, "r", right),
        (Join("two", ("a", "b"), "r", ("id", "b")), "l", left, "r", right),
        (Join("scope", ("b",), "r", ("b",), "exact", ("kind", "y")), "l", left, "r", right),
        (Join("none", ("b",), "r", ("b",), "exact", ("kind", "z")), "l", left, "r", right),
    ])
    assert [tuple(r) for r in found.orderBy("number").collect()] == [(0, 5, 3), (1, 5, 2), (2, 5, 2), (3, 1, 1), (4, 0, 0)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2  # one for all joins, one for those without rows


def test_what_cannot_run_raises_all_of_it(spark, rows):
    docs = [document("one", [("left", ["a"])], declared(resource="ghost"), declared(fields="zz"))]
    plan = joins.plan_joins(joins.documents_frame(spark, docs))
    with pytest.raises(UnusableJoin, match="ghost.*zz|zz.*ghost"):
        joins.run_joins(plan, {})
    docs = [document("one", [("left", ["a"]), ("right", ["id"])], declared())]
    plan = joins.plan_joins(joins.documents_frame(spark, docs))
    with pytest.raises(UnusableJoin, match="no table"):
        joins.run_joins(plan, {("one", "left"): rows("a int", (1,))})
    with pytest.raises(UnusableJoin, match="no column id"):
        joins.run_joins(plan, {("one", "left"): rows("a int", (1,)), ("one", "right"): rows("other int", (1,))})
    none = joins.plan_joins(joins.documents_frame(spark, [document("one", [("left", ["a"])])]))
    assert joins.run_joins(none, {}).collect() == []
