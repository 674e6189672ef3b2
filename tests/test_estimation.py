"""The estimated name model against pairs formed one by one and against plain arithmetic."""

import random
from collections import Counter

import pytest

from concordat.functions.similarity import similarities
from concordat.operators import estimation, linkage

import numpy as np


def names(rng, n):
    words = ["north", "south", "harbour", "bank", "of", "trust", "steel", "works", "grain", "mills", "norths", "harbor"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def test_patterns_equal_formed_pairs(spark, rows):
    rng = random.Random(1)
    left, right = names(rng, 80), names(rng, 90)
    frame = lambda said: linkage.named(rows("id string, name string, country string, status string, jurisdiction string",
                                            *[(str(i), x, rng.choice("AB"), "ISSUED", "US") for i, x in enumerate(said)]))
    l, r = frame(left), frame(right)
    theirs = linkage.register_names(r)
    distinct = l.select("country", "name").distinct()
    pairs = estimation.compared_pairs(distinct, theirs)
    got = {(x["name"], x.tail, x.words): x.pairs for x in estimation.pattern_counts(distinct, theirs, pairs).collect()}
    blocks = lambda name: {("p", name[:6])} | ({("w", name.split(" ")[0])} - {("w", s) for s in linkage.STOPWORDS})
    expected = Counter()
    for a in {tuple(x) for x in distinct.collect()}:
        for b in {tuple(x) for x in theirs.select("country", "name").collect()}:
            if a[0] == b[0] and blocks(a[1]) & blocks(b[1]):
                near = round(float(similarities(np.array([a[1]], object), np.array([b[1]], object))[0]), 9)
                level = "exact" if a[1] == b[1] else "close" if near >= 0.95 else "near" if near >= 0.92 else "else"
                same = lambda f: "same" if f(a[1].split(" ")) == f(b[1].split(" ")) else "else"
                expected[level, same(lambda x: x[-1]), same(len)] += 1
    assert got == dict(expected) and sum(got.values()) > 100


def test_estimation_finds_planted_shares(spark):
    """Patterns drawn from known shares give them back."""
    m = {"name": {"exact": 0.7, "close": 0.2, "near": 0.05, "else": 0.05}, "tail": {"same": 0.95, "else": 0.05}, "words": {"same": 0.9, "else": 0.1}}
    u = {"name": {"exact": 0.01, "close": 0.02, "near": 0.03, "else": 0.94}, "tail": {"same": 0.1, "else": 0.9}, "words": {"same": 0.3, "else": 0.7}}
    prior, total = 0.1, 10_000_000
    rows = [
        (a, b, c, round(total * (prior * m["name"][a] * m["tail"][b] * m["words"][c] + (1 - prior) * u["name"][a] * u["tail"][b] * u["words"][c])))
        for a in m["name"] for b in m["tail"] for c in m["words"]
    ]
    model = estimation.estimate(spark.createDataFrame(rows, "name string, tail string, words string, pairs long"), 400)
    assert model.prior == pytest.approx(prior, abs=2e-3)
    for c in m:
        for level in m[c]:
            assert model.m[c][level] == pytest.approx(m[c][level], abs=5e-3) and model.u[c][level] == pytest.approx(u[c][level], abs=5e-3)


def test_nothing_to_learn_from(spark, rows):
    schema = "id string, name string, country string, status string, jurisdiction string"
    none = linkage.named(rows(schema, ("1", "grain", "A", "ISSUED", "US")))
    other = linkage.named(rows(schema, ("2", "steel", "A", "ISSUED", "US")))
    with pytest.raises(ValueError):
        estimation.learned(none, other)


def test_hot_blocks_are_counted_not_formed(spark, rows):
    """A block of many names is one row a side when it is counted."""
    many = spark.range(3000).selectExpr("'A' as country", "concat('harbour ', cast(id as string)) as name")
    totals = estimation.block_totals(many, many).first()
    assert totals.same_0 == 9_000_000 and totals.same_1 == 3000 and totals.same_2 == 9_000_000 and totals.same_3 == 3000
