"""Targets, draws, permutations and shares of a mix."""

import numpy as np
import pytest

from concordat.llm import mixing
from concordat.llm.queries import op4_mixing


def test_targets():
    assert mixing.targets({}) == {}
    got = mixing.targets({"b": 100, "a": 100, None: 100, "c": 0})
    assert list(sorted(got, key=lambda s: (s is None, s or ""))) == ["a", "b", "c", None]
    assert got == pytest.approx({"a": 450 * 3 / 7, "b": 450 / 7, "c": 0, None: 450 * 3 / 7})
    even = mixing.targets({"a": 100, "b": 100, "c": 100})
    assert even == pytest.approx({"a": 200, "b": 250 / 3, "c": 500 / 3})


def test_draws_meet_quotas_and_agree():
    quotas = np.array([1000, 0, 37, 5000, 1])
    whole = list(mixing.draw_shards(quotas, 64, 0, 10**9, 1))
    parts = [x for low in range(0, 95) for x in mixing.draw_shards(quotas, 64, low, low + 1, 1)]
    assert sum(c for _, _, c in whole).tolist() == quotas.tolist()
    assert [c.sum() for _, _, c in whole[:-1]] == [64] * (len(whole) - 1)
    for (a, f, c), (b, g, d) in zip(whole, parts, strict=True):
        assert a == b and f.tolist() == g.tolist() and c.tolist() == d.tolist()
    at = np.zeros(5, int)
    for _, first, counts in whole:
        assert first.tolist() == at.tolist()
        at += counts


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations(n):
    got = mixing.permuted(np.arange(n), n, 5)
    assert sorted(got.tolist()) == list(range(n))
    assert n < 17 or got.tolist() != list(range(n))


def check(rows):
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    sizes = {s: sum(r.size for r in own) for s, own in by.items()}
    goal = mixing.targets(sizes)
    for s, own in by.items():
        assert {(r.source_size, round(r.target, 6)) for r in own} == {(sizes[s], round(goal[s], 6))}
        assert abs(sum(r.taken for r in own) - goal[s]) <= 64


def test_query(spark, folder):
    source = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source").collect())
    one, two = ([tuple(r) for r in op4_mixing(spark, folder).collect()] for _ in range(2))
    assert sorted(one) == sorted(two) and len(one) == len(source)
    frame = op4_mixing(spark, folder)
    from types import SimpleNamespace

    check([SimpleNamespace(source=source[r.doc_id], **r.asDict()) for r in frame.collect()])


def test_odd_rows(spark):
    rows = [(1, "a b c", "x", 5), (1, "a b c", "x", 5), (2, None, "x", 0), (None, "d " * 500, None, 1000), (3, "", "y", 0), (4, "e " * 900, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").selectExpr("*", "doc_id as uid", "source as s", "text as runs")
    got = mixing.Mix(docs).taken().collect()
    assert sorted((r.size, r.source_size) for r in got) == [(0, 0), (0, 6), (3, 6), (3, 6), (500, 500), (900, 900)]
    assert all(r.taken <= 2 * r.size for r in got)
    assert mixing.Mix(docs.limit(0)).taken().collect() == [] and mixing.mixed_rows(docs.limit(0)).collect() == []


def test_mixed_rows_hold_what_is_taken(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r for r in docs.collect()}
    made = mixing.mixed_rows(docs)
    assert made.columns == docs.columns
    taken = {}
    for r in made.collect():
        assert r.text in texts[r.doc_id].text and r.source == texts[r.doc_id].source and r.n_chars == len(r.text)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    expected = {r.doc_id: r.taken for r in mixing.Mix(docs).taken().collect() if r.taken}
    assert taken.keys() == expected.keys()
    assert abs(sum(taken.values()) - sum(expected.values())) <= 0.01 * sum(expected.values())


def test_texts_are_cut_once_and_sources_need_no_python_worker(frame):
    rows = [(i, f"a b c {i}\n" * (1 + i % 40), s, 0) for i, s in enumerate(["x", None, "y"] * 40)]
    mixed = mixing.mixed_rows(frame(rows, "doc_id long, text string, source string, n_chars int"))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "ExistingRDD" not in plan
    text = {i: t for i, t, _, _ in rows}
    got = mixed.collect()
    assert {r.source for r in got} == {"x", None, "y"} and all(r.text in text[r.doc_id] and r.n_chars == len(r.text) for r in got)
