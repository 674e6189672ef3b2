"""Whole packages on disk, and the functions as SQL sees them."""

import json

import pytest

from concordat.functions.sql import create_functions
from concordat.operators import contract, coverage, export
from concordat.plans.audit import audit_packages, stamp_joins


@pytest.fixture
def package(spark, tmp_path):
    """Writes one package: a folder with a descriptor, and a folder of Parquet files for each of its tables."""

    def write(name, tables, described=True, **more):
        folder = tmp_path / name
        folder.mkdir()
        resources = [{"name": r, "path": r, "schema": schema} for r, (_, schema) in tables.items()]
        document = {"name": name, "resources": resources, **more}
        for r, (table, _) in tables.items():
            (export.with_description(table, document) if described else table).coalesce(1).write.parquet(str(folder / r))
        (folder / "datapackage.json").write_text(json.dumps(document))
        return document

    write.pattern = f"{tmp_path}/*/datapackage.json"
    write.folder = tmp_path
    return write


def fields(**types):
    return [{"name": n, **({"type": t} if isinstance(t, str) else t)} for n, t in types.items()]


HARBOURS = "port string, berths int"


def test_packages_that_say_what_is_so(spark, rows, package):
    ports = rows(HARBOURS, ("Oban", 4), ("Hull", 30))
    calls = rows("ship bigint, port string", (1, "Oban"), (2, "Hull"), (2, "Oban"))
    package("harbours", {"ports": (ports, {"fields": fields(port={"type": "string", "constraints": {"minLength": 3}}, berths="integer"), "primaryKey": "port"})})
    package("traffic", {"calls": (calls, {
        "fields": fields(ship="integer", port={"type": "string", "constraints": {"enum": ["Oban", "Hull"]}}), "primaryKey": ["ship", "port"],
        "foreignKeys": [{"fields": "port", "reference": {"resource": "ports", "fields": "port"}}]})})
    stated = rows("dataset string, stated string", ("ports", "2"), ("calls", "3"))
    assert audit_packages(spark, package.pattern, stated, require_self_description=True).collect() == []


def test_one_list_holds_findings_of_all_kinds(spark, rows, package):
    ports = rows(HARBOURS + ", note string", ("Oban", 4, "a"), ("Oban", None, "b"), ("??", 7, None))
    document = package(
        "harbours",
        {"ports": (ports, {
            "fields": fields(port={"type": "string", "constraints": {"pattern": "[A-Za-z]+"}}, berths={"type": "boolean", "constraints": {"required": True}}, quay="string"),
            "primaryKey": "port", "foreignKeys": [{"fields": "berths", "reference": {"resource": "docks", "fields": "n"}}]})},
        described=False,
        **{"x-joins": {"joins": [{"name": "self", "fields": "port", "reference": {"resource": "ports", "fields": "port"}, "coverage": {"rows": 3, "matched": 1}}]}},
    )
    document["resources"][0]["bytes"] = 1
    (package.folder / "harbours" / "datapackage.json").write_text(json.dumps(document))
    found = audit_packages(spark, package.pattern, rows("dataset string, stated string", ("ports", "9")), require_self_description=True)
    assert sorted({(r.rule, r.field) for r in found.collect()}) == [
        ("catalogue.rows", ""), ("constraints.pattern", "port"), ("constraints.required", "berths"), ("resource.bytes", ""),
        ("schema.fields", "note"), ("schema.fields", "quay"), ("schema.foreignKeys", "berths"), ("schema.primaryKey.duplicate", "port"),
        ("self-description", ""), ("type", "berths"), ("x-joins.coverage", "self")]


@pytest.mark.parametrize("schema", [
    {"fields": fields(port="colour")}, {"fields": fields(port={"constraints": {"unique": True}})}, {"fields": []},
    {"fields": fields(port="string"), "primaryKey": []}, {"fields": fields(port="string"), "primaryKey": 7}])
def test_no_check_is_skipped_in_silence(spark, rows, package, schema):
    package("harbours", {"ports": (rows("port string", ("Oban",)), schema)})
    with pytest.raises(contract.ContractError):
        audit_packages(spark, package.pattern)


def test_some_packages_only(spark, rows, package):
    package("harbours", {"ports": (rows("port string", ("Oban",)), {"fields": fields(port="string")})})
    assert audit_packages(spark, package.pattern, only={"harbours"}).count() == 0
    with pytest.raises(contract.ContractError, match="lighthouses"):
        audit_packages(spark, package.pattern, only={"lighthouses"})


def test_joins_are_stamped_and_then_hold(spark, rows, package):
    ports = rows("port string, code int", ("Oban", 1), ("Hull", 2))
    calls = rows("port_code string, kind string", ("1", "in"), ("2", "in"), ("9", "in"), ("1", "out"), (None, "in"))
    package("harbours", {"ports": (ports, {"fields": fields(port="string", code="integer")})})
    declared = {"name": "at port", "fields": "port_code", "reference": {"resource": "ports", "fields": "code"}, "where": {"field": "kind", "equals": "in"}}
    document = package("traffic", {"calls": (calls, {"fields": fields(port_code="string", kind="string")})}, described=False, **{"x-joins": {"joins": [declared]}})
    path = package.folder / "traffic" / "datapackage.json"
    with pytest.raises(coverage.UnusableJoin, match="coverage"):
        audit_packages(spark, package.pattern)
    stamped = stamp_joins(spark, package.pattern, "traffic")
    assert stamped["x-joins"]["joins"][0]["coverage"] == {"rows": 4, "matched": 2} and "coverage" not in document["x-joins"]["joins"][0]
    path.write_text(json.dumps(stamped))
    assert audit_packages(spark, package.pattern).collect() == []
    fresh = rows("port string, code int", ("Oban", 1), ("Hull", 2), ("Rye", 9))
    assert [r.detail for r in audit_packages(spark, package.pattern, local={"ports": fresh}).collect()] == [
        "states 2 of 4 row(s) matched; there are 3 of 4"]


def test_functions_in_sql(spark):
    create_functions(spark)
    # A published identifier, and the example of the measure's paper.
    got = spark.sql(
        "select lei_mod97('529900T8BM49AURSDO55'), lei_mod97('52990-T8BM49AURSDO55'), lei_mod97(''), lei_mod97(null), "
        "strip_accents('Société Łódź'), round(jaro_winkler_similarity('martha', 'marhta'), 4)").first()
    assert tuple(got) == (1, None, None, None, "Societe Łodz", 0.9611)


def test_declared_joins_are_written_and_checked(rows):
    declared = {"name": "j", "fields": ["key"], "reference": {"resource": "r", "fields": ["id"]}, "compareAs": "text"}
    own = {"edges": rows("key string", ("1",), ("S",))}
    other = {"r": rows("id int", (1,), (2,))}
    measured = coverage.measure_declared(declared, own, other, write=True).first()
    assert (measured.rows, measured.matched) == (2, 1)
    told = {**declared, "coverage": {"rows": measured.rows, "matched": measured.matched}}
    assert coverage.measure_declared(told, own, other).first().agrees
    assert not coverage.measure_declared(told, {"edges": own["edges"].limit(0)}, other).first().agrees
    for broken, theirs in ((declared, other), (told, {})):
        with pytest.raises(coverage.UnusableJoin):
            coverage.measure_declared(broken, own, theirs)


def test_drift_gate(rows):
    table = rows("v string", ("ok",), ("BAD",))
    rule = contract.Rule("v", pattern="[a-z]+")
    assert contract.require_no_drift(contract.check_drift(table.limit(1), [rule])).count() == 1
    with pytest.raises(contract.DriftError, match="BAD"):
        contract.require_no_drift(contract.check_drift(table, [rule]))
