"""Exact top-k against all products."""

import math

import numpy as np
from pyspark.sql import functions as F

from concordat.llm import topk


def plain(rows, asked, k=5):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    kept = [(n, i, w) for n, (i, v) in enumerate(rows) if i is not None and (w := whole(v)) is not None]
    out = []
    for own, i, q in kept:
        if asked(i):
            found = sorted((-sum(a * b for a, b in zip(q, w)), j) for n, j, w in kept if n != own and len(w) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_top_k(spark, folder):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * rng.choice([0.1, 1, 20])]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]
    rows += [(900, None), (901, [None] * 8), (902, [float("nan")] * 8), (903, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    rows += [(904, []), (906, []), (907, [0.0] * 8), (908, [1e9] * 8), (910, [-1e9] * 8), (911, [1.0, 2.0])]
    rows += [(9, rows[9][1]), (9, rows[10][1]), (912, [1.0, 2.0]), (912, [2.0, 1.0])]  # one id, twice: each row is a query
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id as block", "vec_id as vector")
    rows = [(r.vec_id, r.embedding) for r in frame.select("vec_id", "embedding").collect()]
    asked = F.col("vec_id") % 3 == 0
    got = topk.top_k(frame, asked, bucket_rows=64, query_rows=10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, lambda i: i % 3 == 0)
    assert topk.top_k(frame.limit(0), asked).collect() == [] and topk.top_k(frame, F.lit(None).cast("boolean")).collect() == []


def test_long_vectors_and_lengths(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=3000) * 4.0 ** (i % 9)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(frame, F.col("vec_id") % 7 == 0, bucket_rows=5, query_rows=2)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, lambda i: i % 7 == 0)


def test_pruning_loses_nothing():
    rng = np.random.default_rng(5)
    kinds = set()
    for spread in (0.05, 0.3, 2.0):
        centre = rng.normal(size=6)
        matrix = np.floor(256 * (centre + spread * rng.normal(size=(300, 6))))
        bucket = topk.Bucket(np.arange(300), np.arange(300), matrix)
        for q in matrix[:40]:
            scores = bucket.matrix @ q
            for theta in np.quantile(scores, [0.2, 0.9, 0.99, 1.0]):
                found = bucket.candidates(q, float(np.sqrt(q @ q)), float(theta))
                rows = np.arange(300)[found] if found is not None else np.empty(0, int)
                kinds.add(type(found))
                assert set(np.flatnonzero(scores >= theta)) <= set(rows.tolist())
    assert kinds >= {slice, np.ndarray}
    assert bucket.candidates(q, float(np.sqrt(q @ q)), 1e12) is None
