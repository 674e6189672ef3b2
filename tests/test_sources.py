"""Readers and sinks on real files."""

import hashlib
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from concordat.operators import export, inventory, loads
from concordat.operators.contract import ContractError
from concordat.sources import descriptors, objects, readers, runs

REGISTER = [*loads.REGISTER_COLUMNS, "Some.Other.Column", *loads.REGISTER_DATES]


def test_register_csv_quotes_commas_and_dates(spark, rows, tmp_path):
    values = ["A1", 'Say ""Hi"", Inc', "US", "", "US-DE", "XTIQ", "NULL", "ISSUED", "x", "2012-06-06T15:53:00.000Z", "not a date"]
    body = ",".join(f'"{c}"' for c in REGISTER) + "\n" + ",".join(f'"{v}"' for v in values) + "\n"
    (tmp_path / "a.csv").write_text(body)
    (tmp_path / "b.csv").write_text(body.replace("A1", "B2"))
    loaded = loads.load_register(readers.read_text_table(spark, f"{tmp_path}/*.csv"))
    first = loaded.orderBy("lei").first()
    assert loaded.count() == 2
    assert (first.legal_name, first.entity_status, str(first.initial_registration), first.next_renewal) == (
        'Say "Hi", Inc', "NULL", "2012-06-06", None)


def test_line_breaks_inside_a_value(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"k","v"\n"1","two\nlines"\n')
    assert readers.read_text_table(spark, str(tmp_path / "a.csv"), multiline=True).first().v == "two\nlines"


@pytest.mark.parametrize(
    "written,day",
    [("2012-06-06T00:00:00Z", "2012-06-06"), ("2012-13-06", None), ("2012", None), ("2012-06", None), ("", None),
     (None, None), ("2012-6-6", "2012-06-06"), ("2012/06/06", "2012-06-06"), ("x012-06-06", None)],
)
def test_calendar_date(rows, written, day):
    got = rows("v string", (written,)).select(loads.calendar_date(F.col("v"))).first()[0]
    assert (got and str(got)) == day


def test_union_by_name_survives_column_drift(spark, rows, tmp_path):
    for quarter, body in {"q1": "CIK\tLEI\n01\tAA\n", "q2": "LEI\tCIK\nBB\t02\n", "q3": "EXTRA\tCIK\tLEI\nz\t03\tCC\n",
                          "q4": "CIK\tLEI\n04\tDD\n"}.items():
        (tmp_path / quarter).mkdir()
        (tmp_path / quarter / "R.tsv").write_text(body)
    united = readers.read_union_by_name(spark, f"{tmp_path}/*/R.tsv")
    assert rows.of(united, "CIK", "LEI", "EXTRA") == [
        ("01", "AA", None), ("02", "BB", None), ("03", "CC", "z"), ("04", "DD", None)]
    with pytest.raises(Exception):
        readers.read_union_by_name(spark, f"{tmp_path}/none/*.tsv")


def test_lines_keep_names_with_colons(spark, rows, tmp_path):
    (tmp_path / "names.txt").write_text("A: B CORP:0000000012:\nNO KEY\nSHORT:12:\n:0000000013:\nPLAIN:0000000100:\n")
    parsed = loads.parse_name_lines(readers.read_lines(spark, str(tmp_path / "names.txt")))
    assert rows.of(parsed) == [("100", "PLAIN"), ("12", "A: B CORP")]


def test_positional_json_follows_its_header(spark, rows, tmp_path):
    for name, doc in {"a": {"fields": ["cik", "name"], "data": [["0012", "X"], ["13", None]]},
                      "b": {"fields": ["name", "cik"], "data": [["Y", 14]]}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    table = readers.read_positional_json(spark, f"{tmp_path}/*.json")
    got = readers.unpack_positional(table, {"cik": "cik", "company_name": "name", "ticker": "ticker"})
    assert rows.of(got) == [("0012", "X", None), ("13", None, None), ("14", "Y", None)]


def test_taxonomy_quirks(rows):
    frame = rows("code string, title string, description string",
                 ("31-33", "ManufacturingT", "null"), ("11", " Farming ", "  a\n\tb  "), ("111", "T", ""), ("1111", "Oil", "NULL "),
                 ("11111", "Soy", None), ("111110", "SoyT", "ok"))
    got = {r.code: (r.title, r.level, r.description) for r in loads.load_taxonomy(frame).collect()}
    assert got == {
        "31-33": ("Manufacturing", "sector", None), "11": ("Farming", "sector", "a b"), "111": ("", "subsector", None),
        "1111": ("Oil", "industry_group", None), "11111": ("Soy", "naics_industry", None), "111110": ("Soy", "national_industry", "ok")}


DESCRIPTOR = {
    "name": "shop",
    "resources": [{
        "name": "goods", "path": "goods.parquet", "bytes": 10, "hash": "sha256:aa",
        "schema": {
            "fields": [
                {"name": "code", "type": "string", "constraints": {"pattern": "^[A-Z]{2}$", "required": True}},
                {"name": "n", "constraints": {"enum": [1, "b"], "unique": True, "minLength": 1}},
            ],
            "primaryKey": "code",
            "foreignKeys": [{"fields": "n", "reference": {"resource": "", "fields": ["code"]}},
                            {"fields": ["a", "b"], "reference": {"resource": "other", "fields": "k"}}],
        }}],
    "x-joins": {"joins": [{"name": "j", "fields": "code", "reference": {"resource": "other", "fields": ["k"]},
                           "compareAs": "text", "where": {"field": "n", "equals": "b"}, "coverage": {"rows": 2, "matched": 1}}]},
}


def test_descriptors_become_contract_tables(spark, rows, tmp_path):
    for package in ("one", "two"):
        (tmp_path / package).mkdir()
        (tmp_path / package / "datapackage.json").write_text(json.dumps({**DESCRIPTOR, "name": package}, indent=2))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "datapackage.json").write_text("not json")
    found = descriptors.read_descriptors(spark, f"{tmp_path}/*/datapackage.json")
    assert rows.of(found, "package", "readable") == [("one", True), ("two", True), (None, False)]
    fields = descriptors.contract_fields(found).where("package = 'one'")
    assert rows.of(fields, "position", "field", "type", "pattern", "min_length", "enum", "required", "unknown_constraints") == [
        (0, "code", "string", "^[A-Z]{2}$", None, None, True, ""), (1, "n", "any", None, 1, ["1", "b"], False, "unique")]
    assert rows.of(descriptors.contract_keys(found).where("package = 'one'"), "columns") == [(["code"],)]
    joins = descriptors.contract_joins(found).where("package = 'one'").first()
    assert (joins.fields, joins.target_fields, joins.compare_as) == (["code"], ["k"], "text")
    index = descriptors.resource_index(descriptors.contract_resources(found)).first()
    assert (index.resource, index.declarations, index.ambiguous) == ("goods", 2, True)


@pytest.mark.parametrize("declared,columns", [('"a"', ["a"]), ('["a","b"]', ["a", "b"]), ("[]", None), ("7", None), ("{}", None), ('[null]', None)])
def test_key_shapes(rows, declared, columns):
    text = '{"name":"p","resources":[{"name":"r","schema":{"fields":[{"name":"a"}],"primaryKey":%s}}]}' % declared
    found = descriptors.parse_descriptors(rows("t string", (text,)), "t")
    assert descriptors.contract_keys(found).first().columns == columns


def test_run_records_are_read_or_refused(spark, rows, tmp_path):
    good = {"contract_version": "b4/1", "run": {"run_id": "r1", "started_at": "2026", "outcome": "success"}, "assets": [], "steps": []}
    records = {"a": good, "b": {**good, "contract_version": "b4/2"}, "c": {k: v for k, v in good.items() if k != "run"},
               "d": {k: v for k, v in good.items() if k != "steps"}}
    for name, record in records.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(record, indent=1))
    (tmp_path / "e.json").write_text("[broken")
    got = runs.read_runs(spark, f"{tmp_path}/*.json").withColumn("file", F.regexp_extract("source", "([a-z])[.]json", 1))
    assert rows.of(got, "file", "error") == [
        ("a", None), ("b", "declares contract version b4/2"), ("c", "declares no run block"),
        ("d", "declares no steps or assets"), ("e", "is not a readable run record")]


def test_object_inventory_is_size_and_sha256(spark, rows, tmp_path):
    bodies = {"a.bin": b"abc", "b.bin": os.urandom(9_000_000)}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    got = objects.object_inventory(spark, f"{tmp_path}/*.bin").collect()
    assert {os.path.basename(r.path): (r.bytes, r.hash) for r in got} == {
        n: (len(b), "sha256:" + hashlib.sha256(b).hexdigest()) for n, b in bodies.items()}


def test_layout_and_mixed_codecs(spark, tmp_path):
    table = pa.table({"a": list(range(250))})
    pq.write_table(table, tmp_path / "one.parquet", row_group_size=100, compression="zstd")
    layout = objects.parquet_layout(objects.parquet_row_groups(spark, f"{tmp_path}/*.parquet")).first()
    assert (layout.files, layout.row_groups, layout.rows, layout.widest_row_group, layout.codec) == (1, 3, 250, 100, "zstd")
    pq.write_table(table, tmp_path / "two.parquet", compression="snappy")
    assert objects.parquet_layout(objects.parquet_row_groups(spark, f"{tmp_path}/*.parquet")).first().codec is None


def test_export_is_ordered_laid_out_and_changes_no_row(spark, tmp_path):
    table = spark.range(5000).select((F.col("id") * 7919 % 100).alias("a"), F.col("id").alias("b"), F.lit(None).cast("string").alias("c"))
    path = str(tmp_path / "out")
    export.export_ordered(table, path, ["a", "b"], 300, files=6)
    report = export.order_report(spark, path, ["a", "b"]).first()
    assert (report.rows, report.out_of_order, report.overlapping_files) == (5000, 0, 0) and report.files > 1
    layout = objects.parquet_layout(objects.parquet_row_groups(spark, f"{path}/*.parquet")).first()
    assert layout.widest_row_group == 300 and layout.codec == "zstd"
    back = spark.read.parquet(path)
    digest = inventory.content_digest(table, "t")
    assert inventory.unchanged(digest, inventory.content_digest(back, "t")).first().unchanged
    for other in (back.where("b <> 17"), back.withColumn("a", F.when(F.col("b") == 3, 5).otherwise(F.col("a"))), back.union(back.limit(1))):
        assert not inventory.unchanged(digest, inventory.content_digest(other, "t")).first().unchanged


def test_order_report_sees_disorder(spark, tmp_path):
    path = str(tmp_path / "bad")
    spark.createDataFrame([(2,), (1,), (3,)], "a int").coalesce(1).write.parquet(path)
    assert export.order_report(spark, path, ["a"]).first().out_of_order == 1


def description(**changes):
    fields = [{"name": "a", "type": "integer"}, {"name": "b", "type": "string"}]
    return {"name": "p", "resources": [{"name": "r", "bytes": 5, "hash": "sha256:0", "schema": {"fields": fields, **changes}}]}


@pytest.fixture
def carrier(spark, tmp_path):
    def write(document, metadata=None):
        table = spark.createDataFrame([(1, "x"), (1, "y")], "a bigint, b string")
        path = str(tmp_path / f"t{len(os.listdir(tmp_path))}")
        carried = export.with_description(table, document) if metadata is None else table.withMetadata("a", metadata)
        carried.write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_a_true_self_description_is_silent(carrier):
    table = carrier(description())
    assert "bytes" not in json.loads(export.read_description(table))["resources"][0]
    assert export.check_self_description(table, description(), "p", "r", True).count() == 0


def test_a_lying_self_description_is_reported(carrier, rows):
    lying = description(primaryKey="a")
    lying["resources"][0]["schema"]["fields"] = [{"name": "a", "type": "date"}, {"name": "z", "type": "money"}]
    found = export.check_self_description(carrier(lying), lying, "p", "r")
    assert rows.of(found, "field", "rule") == [
        ("a", "self-description.schema.primaryKey.duplicate"), ("a", "self-description.type"),
        ("b", "self-description.schema.fields"), ("z", "self-description.schema.fields")]


def test_self_description_shapes(spark, carrier):
    plain = spark.createDataFrame([(1, "x")], "a bigint, b string")
    assert export.check_self_description(plain, description(), "p", "r").count() == 0
    assert export.check_self_description(plain, description(), "p", "r", require=True).count() == 1
    for text in ("{broken", "[1]"):
        table = carrier(None, {export.DESCRIPTION: text})
        assert export.check_self_description(table, description(), "p", "r").count() == 1
    stating = carrier(None, {export.DESCRIPTION: json.dumps(description())})
    details = [r.detail for r in export.check_self_description(stating, description(), "p", "r").collect()]
    assert "states its own bytes inside itself" in details and "differs at /resources/0/hash: unexpected" in details
    twice = plain.withMetadata("a", {export.DESCRIPTION: "{}"}).withMetadata("b", {export.DESCRIPTION: "{}"})
    with pytest.raises(ContractError):
        export.read_description(twice)
    unreadable = description(primaryKey=7)
    assert export.check_self_description(carrier(unreadable), unreadable, "p", "r").count() == 1


def test_a_null_that_moves_changes_the_digest(rows):
    one, two = rows("a int, b int", (None, 1)), rows("a int, b int", (1, None))
    assert not inventory.unchanged(inventory.content_digest(one, "t"), inventory.content_digest(two, "t")).first().unchanged


def test_a_register_value_may_hold_a_line_break(spark, tmp_path):
    (tmp_path / "r.csv").write_text('LEI,Name\nA,"Two\nLines"\nB,One\n')
    assert readers.read_text_table(spark, str(tmp_path), multiline=True).count() == 2
