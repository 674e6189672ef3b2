"""Runs against brute force over all starts and periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from concordat.llm import periods, queries


def plain_runs(words):
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - at + q if end > at else 0
            if length >= max(6, 4 * q) and not any(
                all(words[i] == words[i + p] for i in range(at, at + length - p)) for p in range(1, q)
            ):
                found.add((at, length, q))
            at = max(end, at + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, rewrite=True):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if rewrite and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    exponent = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_small_alphabets():
    rng = random.Random(4)
    for _ in range(400):
        texts = []
        for _ in range(3):
            words = []
            while len(words) < rng.randint(0, 60):
                root = [rng.randint(0, 2) for _ in range(rng.randint(1, 6))]
                words += (root * rng.randint(1, 7))[: rng.randint(1, 40)]
            texts.append(words)
        flat = np.array([w for t in texts for w in t], np.int64)
        owner = np.repeat(np.arange(3), [len(t) for t in texts])
        got = list(zip(*(x.tolist() for x in periods.find_runs(flat, owner, 6, 4))))
        expected, base = [], 0
        for words in texts:
            expected += [(base + s, size, q) for s, size, q in plain_runs(words)]
            base += len(words)
        assert got == expected


def test_fewer_repeats_are_refused():
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(3, np.int64), np.zeros(3, np.int64), 2, 3)


def test_odd_rows(frame, documents):
    rows = documents + [(1007, "a b " * 5000 + "c"), (1008, " ".join(["x"] * 6)), (1008, " ".join(["x"] * 5)), (None, "y " * 9)]
    rows = [(i, t) for i, t in rows if len((t or "").split()) < 2000 or i in (1007, -6)]
    plain = [(i, t) for i, t in rows if i not in (1007, -6)]
    got = periods.run_digests(periods.collapse_runs(frame(rows).selectExpr("*", "1 as runs", "2 as collapsed"), rewrite=periods.repeat_tail)).collect()
    small = sorted([tuple(r) for r in got if r.doc_id not in (1007, -6)], key=repr)
    assert small == sorted([plain_row(i, t) for i, t in plain], key=repr)
    assert [tuple(r)[1:6] for r in got if r.doc_id == 1007] == [(1, 0, 10_000, 2, 5_000_000)]
    long = [tuple(r)[1:5] for r in got if r.doc_id == -6]
    assert long == [(1, 0, 30_000, 1)] * 2
    assert periods.run_digests(periods.collapse_runs(frame([]))).collect() == []


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r) for r in queries.op12_periods(spark, folder).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        if len((t or "").split()) < 1500:
            assert got[i] == plain_row(i, t)
