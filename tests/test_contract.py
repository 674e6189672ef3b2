"""Each rule on data that keeps it, and on data that breaks it alone."""

import json

import pytest
from pyspark.sql import functions as F

from concordat.operators import contract, coverage, documents, profile, provenance, registry
from concordat.operators.catalogue import check_catalogue, count_rows
from concordat.operators.contract import ContractError, Rule
from concordat.operators.coverage import Join, UnusableJoin, read_join
from concordat.operators.inventory import verify_objects
from concordat.sources import descriptors, runs


def found(frame):
    return sorted((r.field, r.rule) for r in frame.collect())


def check(table, *rules):
    return contract.check_constraints(table, list(rules), "p", "r")


def test_a_conformant_table_is_silent(rows):
    table = rows("code string, label string", ("AB", "alpha"), ("CD", "beta"))
    assert check(table, Rule("code", pattern="^[A-Z]{2}$"), Rule("label", min_length=4, max_length=8)).count() == 0


@pytest.mark.parametrize(
    "value,rule,name",
    [("US-DE", Rule("v", pattern="^[A-Z]{2}$"), "pattern"), ("AB\n", Rule("v", pattern="^[A-Z]{2}$"), "pattern"),
     ("x", Rule("v", min_length=2), "minLength"), ("a-very-long-label", Rule("v", max_length=8), "maxLength"),
     ("galaxy", Rule("v", enum=("star", "moon")), "enum"), ("any", Rule("v", enum=()), "enum"), (None, Rule("v", required=True), "required")],
)
def test_each_constraint_reddens_alone(rows, value, rule, name):
    table = rows("v string", (value,))
    assert found(check(table, rule)) == [("v", f"constraints.{name}")]


def test_null_passes_all_but_required(rows):
    table = rows("v string", (None,))
    assert check(table, Rule("v", pattern="x", min_length=3, max_length=1, enum=())).count() == 0


def test_counts_and_smallest_example(rows):
    table = rows("v string", ("zz",), ("b",), ("a",), (None,), ("",))
    detail = check(table, Rule("v", min_length=2)).first().detail
    assert detail == "3 of 4 value(s) shorter than 2; e.g. ''"


def test_unknown_constraints_stop_the_check_and_bad_patterns_are_findings(rows):
    table = rows("v string, w string", ("a", "b"))
    with pytest.raises(ContractError):
        check(table, Rule("v", unknown=("unique",)))
    assert found(check(table, Rule("v", pattern="("), Rule("w", pattern="c"))) == [("v", "constraints.pattern"), ("w", "constraints.pattern")]
    assert check(table, Rule("absent", pattern="c")).count() == 0


def test_more_probes_than_one_scan_takes(rows, monkeypatch):
    monkeypatch.setattr(contract, "PROBES_PER_SCAN", 2)
    table = rows("v string, w string", ("abc", "d"))
    rules = [Rule("v", pattern="x", min_length=4, max_length=2, enum=("q",)), Rule("w", pattern="x")]
    assert len(found(check(table, *rules))) == 5


def test_field_set_and_types(spark, rows):
    table = spark.sql("select 1 a, 'x' b, date'2020-01-01' c, cast(1 as decimal(38,0)) d, cast(1 as decimal(9,2)) e, array(1) f, "
                      "named_struct('x',1) g, true h, timestamp'2020-01-01 00:00:00' i, interval 1 day j, 1.5D k")
    physical = contract.physical_fields(table, "p", "r")
    kinds = {r.field: r.physical for r in physical.collect()}
    assert kinds == {"a": "int", "b": "string", "c": "date", "d": "hugeint", "e": "decimal", "f": "array", "g": "struct",
                     "h": "boolean", "i": "timestamp", "j": "interval", "k": "double"}
    good = {"a": "integer", "b": "string", "c": "date", "d": "integer", "e": "number", "f": "array", "g": "object", "h": "boolean",
            "i": "datetime", "j": "duration", "k": "number"}
    declare = lambda types: rows("package string, resource string, field string, type string", *[("p", "r", f, t) for f, t in types.items()])
    assert contract.check_types(declare(good), physical).count() == 0
    assert contract.check_types(declare({f: "any" for f in good}), physical).count() == 0
    wrong = {"a": "string", "b": "integer", "c": "datetime", "k": "integer", "e": "integer", "h": "money"}
    bad = contract.check_types(declare(wrong), physical)
    assert found(bad) == [("a", "type"), ("b", "type"), ("c", "type"), ("e", "type"), ("h", "type.unknown"), ("k", "type")]
    with pytest.raises(ContractError, match="money"):
        contract.require_checkable(bad)
    absent = contract.check_field_set(declare({**good, "zz": "any"}).where("field <> 'a'"), physical)
    assert sorted((r.field, "undeclared" in r.detail) for r in absent.collect()) == [("a", True), ("zz", False)]


@pytest.mark.parametrize(
    "values,expected",
    [([("AB", 1), ("CD", 1)], (2, 0, None, 0, 0, None, None)),
     ([("AB", 1), ("AB", 1), ("CD", 1)], (3, 0, None, 1, 2, "('AB', '1')", 2)),
     ([("AB", 1), (None, 1), (None, 1)], (3, 2, "(NULL, '1')", 0, 0, None, None)),
     ([("AB", 1), ("AB", 1), ("AB", 2), ("AB", None)], (4, 1, "('AB', NULL)", 1, 2, "('AB', '1')", 2)),
     ([], (0, 0, None, 0, 0, None, None))],
)
def test_missing_and_repeated_keys_are_counted_apart(rows, values, expected):
    table = rows("code string, tag int", *values)
    assert tuple(contract.key_scan(table, ["code", "tag"]).first()) == expected


def test_primary_key_findings(rows):
    table = rows("code string, tag int", ("AB", 1), ("AB", 2), (None, 3))
    key = lambda *columns, prefix="": found(contract.check_primary_key(table, list(columns) or None, "p", "r", prefix))
    assert key("tag") == []
    assert key("code") == [("code", "schema.primaryKey.duplicate"), ("code", "schema.primaryKey.null")]
    assert key("code", "x", "y") == [("x", "schema.primaryKey"), ("y", "schema.primaryKey")]
    assert key(prefix="self-description.") == [("", "self-description.schema.primaryKey")]
    with pytest.raises(ContractError):
        key()


def packages(rows, *specs):
    texts = []
    for name, resource, fields, keys in specs:
        schema = {"fields": [{"name": n, "type": t} for n, t in fields.items()], "foreignKeys": keys}
        texts.append((json.dumps({"name": name, "resources": [{"name": resource, "schema": schema}]}),))
    return descriptors.parse_descriptors(rows("t string", *texts), "t")


def foreign(rows, left, keys, right, extra=()):
    d = packages(rows, ("a", "edges", left, keys), ("b", "firms", right, []), *extra)
    return [r.detail for r in contract.check_foreign_keys(
        descriptors.contract_foreign_keys(d), descriptors.contract_fields(d), descriptors.contract_resources(d)).collect()]


def test_foreign_keys(rows):
    key = lambda fields, target, theirs: [{"fields": fields, "reference": {"resource": target, "fields": theirs}}]
    firms = {"cik": "integer", "x": "any"}
    assert foreign(rows, {"key": "integer"}, key("key", "firms", "cik"), firms) == []
    assert foreign(rows, {"key": "year"}, key(["key"], "firms", ["cik"]), firms) == []
    assert foreign(rows, {"key": "date"}, key("key", "firms", "x"), firms) == []
    assert foreign(rows, {"key": "string"}, key("key", "firms", "cik"), firms) == ["declared string refers to firms.cik declared integer"]
    assert foreign(rows, {"key": "string"}, key("nokey", "firms", "cik"), firms) == ["no such field here: nokey"]
    assert foreign(rows, {"key": "string"}, key("key", "firms", "nocik"), firms) == ["refers to firms.nocik, which is not declared"]
    assert foreign(rows, {"key": "string"}, key("key", "nowhere", "cik"), firms) == ["refers to nowhere, which nothing declares"]
    assert foreign(rows, {"key": "string"}, key(["key", "key"], "firms", "cik"), firms) == ["maps 2 field(s) onto 1"]
    twice = [("c", "firms", firms, [])]
    assert foreign(rows, {"key": "integer"}, key("key", "firms", "cik"), firms, twice) == ["refers to firms, declared 2 times"]
    own = [{"fields": "key", "reference": {"fields": "key"}}]
    assert foreign(rows, {"key": "string"}, own, firms) == []


def test_published_defects(rows):
    """A numeric column declared text, and codes that outgrew their declared shapes."""
    table = rows("cik bigint, key string, jurisdiction string", (1, "S000105435", "US-DE"), (2, "1", "US"))
    declared = rows("package string, resource string, field string, type string", ("p", "r", "cik", "string"), ("p", "r", "key", "string"))
    physical = contract.physical_fields(table, "p", "r")
    rules = [Rule("key", pattern="^[0-9]+$", max_length=9), Rule("jurisdiction", pattern="^[A-Z]{2}$", max_length=2)]
    findings = contract.union_all([
        contract.check_field_set(declared, physical), contract.check_types(declared, physical), check(table, *rules)])
    assert found(findings) == [
        ("cik", "type"), ("jurisdiction", "constraints.maxLength"), ("jurisdiction", "constraints.pattern"), ("jurisdiction", "schema.fields"),
        ("key", "constraints.maxLength"), ("key", "constraints.pattern")]
    assert {r.rule: r.findings for r in contract.count_findings(findings).collect()} == {
        "type": 1, "schema.fields": 1, "constraints.maxLength": 2, "constraints.pattern": 2}


def test_drift_does_not_see_null_or_blank(rows):
    table = rows("v string, n double", ("ok", 1e-7), (None, 0.5), ("  ", None), ("BAD", 2.0))
    rules = [Rule("v", pattern="[a-z]+", required=True), Rule("n", pattern="[01](\\.[0-9]+)?")]
    got = {r.field: (r.broken, r.checked, r.example) for r in contract.check_drift(table, rules).collect()}
    assert got == {"v": (1, 2, "BAD"), "n": (1, 3, "2.0")}


def test_rules_come_from_the_descriptor(rows):
    text = json.dumps({"name": "p", "resources": [{"name": "r", "schema": {"fields": [
        {"name": "a", "type": "string", "constraints": {"enum": ["x", 1], "required": True, "maxLength": 3}}, {"name": "b"}]}}]})
    fields = descriptors.contract_fields(descriptors.parse_descriptors(rows("t string", (text,)), "t"))
    assert contract.rules_of(fields, "p", "r") == [Rule("a", "string", None, None, 3, ("x", "1"), True), Rule("b")]


# Coverage


@pytest.fixture
def typed(rows):
    left = rows("key_type string, key string", ("num", "101"), ("num", "102"), ("num", "999"), ("pre", "S000000001"))
    return left, rows("id int", (101,), (102,), (777,), (101,))


def measured(left, right, join):
    return tuple(coverage.join_coverage(left, right, join).first())[1:]


def test_coverage_as_text(typed):
    left, right = typed
    assert measured(left, right, Join("j", ("key",), "r", ("id",), "text", ("key_type", "num"))) == (3, 2)
    assert measured(left, right, Join("j", ("key",), "r", ("id",), "text")) == (4, 2)
    checked = lambda c: coverage.check_coverage(coverage.join_coverage(left, right, Join("j", ("key",), "r", ("id",), "text")),
                                                Join("j", ("key",), "r", ("id",), "text", coverage=c)).first().agrees
    assert checked((4, 2)) and not checked((4, 3)) and not checked((5, 2))


def test_exact_comparison_fails_on_text_that_is_no_number(typed):
    left, right = typed
    assert measured(left, right, Join("j", ("key",), "r", ("id",), "exact", ("key_type", "num"))) == (3, 2)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        measured(left, right, Join("j", ("key",), "r", ("id",), "exact"))


def test_missing_keys_match_nothing_and_hot_keys_do_not_fan_out(rows):
    left = rows("k string", *[("hot",)] * 500, (None,), ("cold",))
    right = rows("k string", *[("hot",)] * 50, (None,))
    assert measured(left, right, Join("j", ("k",), "r", ("k",))) == (502, 500)


def test_sample(typed):
    left, right = typed
    join = Join("j", ("key",), "r", ("id",), "text")
    assert [r.key for r in coverage.join_sample(left.union(left), right, join, 3).collect()] == ["101", "101", "102"]


DECLARED = {"name": "j", "fields": "key", "reference": {"resource": "r", "fields": ["id"]}, "compareAs": "text",
            "where": {"field": "key_type", "equals": "num"}, "coverage": {"rows": 3, "matched": 2}}


def test_declarations_are_read(typed):
    join = read_join(DECLARED)
    assert join == Join("j", ("key",), "r", ("id",), "text", ("key_type", "num"), (3, 2))
    assert coverage.left_side({"edges": typed[0], "other": typed[1]}, join) == "edges"
    assert read_join({k: v for k, v in DECLARED.items() if k != "coverage"}, need_coverage=False).coverage is None
    for tables in ({"other": typed[1]}, {"a": typed[0], "b": typed[0]}):
        with pytest.raises(UnusableJoin):
            coverage.left_side(tables, join)


@pytest.mark.parametrize("change", [
    {"compareAs": "fuzzy"}, {"fields": []}, {"fields": ["a", "b"]}, {"reference": {"fields": "id"}}, {"where": {"field": "x"}},
    {"where": {"field": "x", "equals": 1, "not": 2}}, {"coverage": None}, {"coverage": {"rows": 1}}, {"coverage": {"rows": 1, "matched": 2}},
    {"coverage": {"rows": True, "matched": 0}}, {"coverage": {"rows": -1, "matched": -2}}])
def test_malformed_declarations_are_errors(change):
    with pytest.raises(UnusableJoin):
        read_join({**DECLARED, **change})


# Profiles, catalogue, objects, runs, registry, documents


def test_profile_and_overlay(rows, monkeypatch):
    monkeypatch.setattr(profile, "DOMAIN_LIMIT", 3)
    table = rows("a string, b int, c string", ("x", 1, None), ("y", 22, None), ("x", 333, None), (None, 4444, None))
    got = profile.profile_columns(table)
    assert rows.of(got) == [
        (0, "a", "string", 4, 1, 2, 1, 1, "x|y"), (1, "b", "integer", 4, 0, 4, 1, 4, None), (2, "c", "string", 4, 4, 0, None, None, None)]
    curated = rows("column string, type string, description string, pattern string, min_length int, max_length int, required boolean",
                   ("b", "string", "a code", None, None, 9, True))
    laid = {r.column: tuple(r) for r in profile.overlay_descriptor(got, curated).collect()}
    assert laid["b"] == (1, "b", "string", "a code", None, 1, 9, True, True)
    assert laid["a"] == (0, "a", "string", None, None, 1, 1, False, False)
    profile.check_curated_keys(table, ["a", "b"])
    with pytest.raises(profile.OverlayError, match="zz"):
        profile.check_curated_keys(table, ["a", "zz"])


def test_catalogue(spark, rows):
    claims = rows("dataset string, stated string", ("a", "1.2K"), ("b", "1.2K"), ("c", "lots"), ("gone", "3"))
    counts = count_rows({"a": spark.range(1234), "b": spark.range(1250), "c": spark.range(5), "unstated": spark.range(7)})
    assert rows.of(check_catalogue(claims, counts)) == [
        ("a", "1.2K", 1234, "1.2K", None), ("b", "1.2K", 1250, "1.3K", "catalogue.rows"), ("c", "lots", 5, "lots", "catalogue.unreadable"),
        ("gone", "3", None, "3", "catalogue.unknown"), ("unstated", None, 7, None, "catalogue.missing")]


def test_objects_are_verified_and_restamped(rows):
    declared = rows("object string, bytes bigint, hash string", ("a", 1, "h"), ("b", 2, "h"), ("c", 3, "h"), ("d", 4, "h"))
    seen = rows("object string, bytes bigint, hash string", ("a", 1, "h"), ("b", 5, "h"), ("c", 3, "other"))
    assert rows.of(verify_objects(declared, seen), "object", "finding", "stamped_bytes", "stamped_hash") == [
        ("a", None, 1, "h"), ("b", "resource.bytes", 5, "h"), ("c", "resource.hash", 3, "other"), ("d", "object.missing", 4, "h")]


def record(run, started="2026-01-01", outcome="success", hash="sha256:d", described="sha256:m", export=("success", None),
           describe=("success", None), producer="export", describer="describe", drop=False):
    assets = [{"kind": "file", "path": "out.parquet", "content_hash": hash, "produced_by": producer},
              {"kind": "table", "path": "datapackage.json", "content_hash": "sha256:zz", "produced_by": "describe"}]
    if not drop:
        assets.append({"kind": "file", "path": "datapackage.json", "content_hash": described, "produced_by": describer})
    steps = [{"name": n, "status": {"state": s, "skip_reason": r}} for n, (s, r) in (("export", export), ("describe", describe))]
    return (json.dumps({"contract_version": "b4/1", "run": {"run_id": run, "started_at": started, "outcome": outcome},
                        "assets": assets, "steps": steps}), run)


def licence(rows, *records):
    parsed = runs.parse_runs(rows("t string, s string", *records), "t", "s")
    objects = rows("object string, hash string, descriptor_hash string", ("o", "sha256:d", "sha256:m"))
    got = provenance.run_provenance(parsed, objects, "datapackage.json").first()
    return got.run_id, got.refusal, got.claimants


def test_provenance_ladder(rows):
    never = "never reached the step that writes the descriptor"
    assert licence(rows, record("r1")) == ("r1", None, 1)
    assert licence(rows, record("r1", hash="d", described="m")) == ("r1", None, 1)
    assert licence(rows, record("r1", describe=("skipped", "hash_clean"))) == ("r1", None, 1)
    assert licence(rows, record("r1", describe=("skipped", None), outcome="partial")) == (None, never, 1)
    assert licence(rows, record("r1", describer=None)) == (None, never, 1)
    assert licence(rows, record("r1", describer="ghost")) == (None, never, 1)
    assert licence(rows, record("r1", drop=True)) == (None, "records no descriptor", 1)
    assert licence(rows, record("r1", described="sha256:old", outcome="partial")) == (None, "wrote another descriptor", 1)
    assert licence(rows, record("r1", outcome="partial")) == (None, "did not finish", 1)
    none = "no run produced these bytes"
    assert licence(rows, record("r1", hash="sha256:else")) == (None, none, 0)

    assert licence(rows, record("r1", producer=None)) == (None, none, 0)
    assert licence(rows, record("r1", export=("skipped", None))) == (None, none, 0)
    assert licence(rows, record("r1", export=("failed", None))) == (None, none, 0)


def test_an_object_without_a_descriptor_is_not_licensed(rows):
    parsed = runs.parse_runs(rows("t string, s string", record("r1")), "t", "s")
    objects = rows("object string, hash string, descriptor_hash string", ("o", "sha256:d", None))
    got = provenance.run_provenance(parsed, objects, "datapackage.json").first()
    assert (got.run_id, got.refusal) == (None, "wrote another descriptor")


def test_the_newest_licensing_run_wins(rows):
    records = [record("old", "2026-01-01"), record("new", "2026-02-01"), record("newest", "2026-03-01", outcome="partial")]
    assert licence(rows, *records) == ("new", None, 3)
    failed = [record("a", "2026-01-01", drop=True), record("b", "2026-02-01", outcome="failed")]
    assert licence(rows, *failed) == (None, "did not finish", 2)


def test_registry_invariants(rows):
    entries = rows("uid string, schema string, name string, aliases array<string>",
                   ("u1", "source", "a", []), ("u2", "source", "b", ["old"]), ("u3", "crosswalk", "c", None), ("u3", "crosswalk", "d", None),
                   ("u4", "source", "old", []), ("u5", "source", "a", []))
    assert rows.of(registry.registry_invariants(entries), "rule", "subject", "claims") == [
        ("address.shared", "source.a", 2), ("alias.repointed", "source.old", 2), ("uid.reused", "u3", 2)]
    assert registry.registry_invariants(entries.where("uid in ('u1', 'u2')")).count() == 0


def diff(rows, a, b):
    frame = lambda v: rows("k int, body string", (1, json.dumps(v)))
    return rows.of(documents.document_diff(frame(a), frame(b), "k", "body"), "pointer", "finding")


def test_document_diff(rows):
    base = {"a": 1, "b": [1, {"c": "x"}], "d": {"e": None, "f": True}, "a-b": 1}
    assert diff(rows, base, {"d": {"f": True, "e": None}, "a-b": 1.0, "b": [1.0, {"c": "x"}], "a": 1}) == []
    assert diff(rows, base, {**base, "a": 2, "b": [1]}) == [("/a", "value"), ("/b", "length")]
    assert diff(rows, base, {**base, "b": [1, {"c": "y"}], "d": []}) == [("/b/1/c", "value"), ("/d", "kind")]
    assert diff(rows, base, {k: v for k, v in base.items() if k != "d"} | {"n": {"m": 1}}) == [("/d", "absent"), ("/n", "unexpected")]
    assert diff(rows, {"a": True}, {"a": 1}) == [("/a", "kind")]
    assert diff(rows, {"a": {"x": 1}, "a-b": 1, "ab": 1}, {"a-b": 2, "ab": 2}) == [("/a", "absent"), ("/a-b", "value"), ("/ab", "value")]
    assert diff(rows, [1], {"a": 1}) == [("/", "kind")]


def test_document_diff_of_a_lost_document(rows):
    a = rows("k int, body string", (1, "{}"), (2, "[1]"))
    b = rows("k int, body string", (1, "{}"), (3, "4"))
    assert rows.of(documents.document_diff(a, b, "k", "body")) == [(2, "/", "absent", "array", None), (3, "/", "unexpected", None, "number")]


def test_bytes_that_very_many_runs_claim(spark, rows):
    records = [record(f"r{n}", f"2026-01-{n % 28 + 1:02d}", outcome="success" if n == 17 else "partial") for n in range(200)]
    assert licence(rows, *records) == ("r17", None, 200)


def test_long_texts_are_profiled_whole(rows):
    long = "x" * 5000
    table = rows("t string", (long + "a",), (long + "b",), (long + "a",), ("s",))
    assert rows.of(profile.profile_columns(table), "distinct_values", "min_length", "max_length", "domain") == [
        (3, 1, 5001, "|".join(["s", long + "a", long + "b"]))]


def test_a_domain_at_the_limit_is_whole(spark):
    table = spark.range(20000).select((F.col("id") % 50).cast("string").alias("a"), (F.col("id") % 51).cast("string").alias("b"))
    got = {r.column: r.domain for r in profile.profile_columns(table).collect()}
    assert got == {"a": "|".join(sorted(str(n) for n in range(50))), "b": None}
