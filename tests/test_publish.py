"""Publishing: order, gate, manifest; and the order report on files that are not in order."""

import pytest

from concordat.functions.identifiers import with_check_digits
from concordat.operators import edges, export, publish
from pyspark.sql import functions as F

ORDER = ["key", "lei"]


@pytest.fixture
def built(spark):
    """Edges whose identifiers hold."""
    return spark.range(1000).select(
        (F.col("id") % 50).cast("string").alias("key"), with_check_digits(F.concat(F.lit("529900Q"), F.lpad(F.col("id").cast("string"), 11, "0"))).alias("lei"))


def test_good_edges_are_published_in_order(spark, built, rows, tmp_path):
    register = rows("lei string", ("none",))
    publish.publish_edges(built, register, str(tmp_path), ORDER)
    got = publish.read_published(spark, str(tmp_path)).orderBy("rank").collect()
    assert [(r.key, r.lei) for r in got] == sorted((r.key, r.lei) for r in built.collect()) and [r.rank for r in got] == list(range(1, 1001))
    again = built.where("key = '7'")
    publish.publish_edges(again, register, str(tmp_path), ORDER)
    assert publish.read_published(spark, str(tmp_path)).count() == 20
    assert [r.rows for r in publish.manifest(spark, str(tmp_path)).orderBy("at").collect()] == [1000, 20]


def test_one_bad_edge_publishes_nothing(spark, built, rows, tmp_path):
    register = rows("lei string", ("ODD BUT LISTED",))
    bad = built.unionByName(rows("key string, lei string", ("1", "ODD BUT LISTED"), ("1", "NAMES NOTHING")))
    with pytest.raises(edges.GateError, match="NAMES NOTHING"):
        publish.publish_edges(bad, register, str(tmp_path), ORDER)
    assert not list(tmp_path.glob("manifest/*.parquet"))
    passing, refused = edges.split_edges(bad, register)
    assert [tuple(r) for r in refused.collect()] == [("1", "NAMES NOTHING")]
    publish.publish_edges(passing, register, str(tmp_path), ORDER)
    assert publish.read_published(spark, str(tmp_path)).count() == 1001


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_slices_find_each_step_out_of_order(spark, tmp_path, size):
    """Rows compared in slices of any size give what a walk over the file gives."""
    values = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9]
    path = f"{tmp_path}/one"
    spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.parquet(path)
    report = export.order_report(spark, path, ["v"], size).first()
    assert (report.files, report.rows, report.out_of_order) == (1, 15, sum(b < a for a, b in zip(values, values[1:])))
    assert [r.v for r in export.ranked_rows(spark, path).orderBy("rank").collect()] == values


def test_an_empty_table_has_no_rows_out_of_order(spark, rows, tmp_path):
    path = f"{tmp_path}/none"
    export.export_ordered(rows("v int"), path, ["v"], 10)
    assert export.order_report(spark, path, ["v"]).first().out_of_order == 0


def test_the_published_crosswalk_works_its_edges_out_once(spark, monkeypatch):
    from concordat import session
    from concordat.plans import queries

    kept, names = session.staged, []
    monkeypatch.setattr(session, "staged", lambda table, name: (names.append(name), kept(table, name))[1])
    queries.registered()["published_crosswalk"](spark, "/root/testdata/sf0.001")
    assert names == ["edges"]
