"""The draw against plain Python, the selection against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from concordat.llm import queries, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain_draw(docs, target):
    s, t = Counter(), Counter()
    told = [(i, *plain_buckets(x)) for i, x in docs]
    for _, _, b in told:
        s.update(b)
    for x in target:
        t.update(plain_buckets(x)[1])
    of_s, of_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (of_s + 10_000) / ((s[b] + 1) * (of_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n, b in told:
        weight = sum(gain[x] for x in b)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    ranks = Counter()
    out = []
    drawn = able[: len(able) * 5 // 100]
    for r in rows:
        places = [k for k, d in enumerate(drawn, 1) if d is r]
        out.append((r[0], *r[2:], places[0] if places else None))
    return sorted(out, key=repr), ranks


def test_checksums_move():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (bytes(rng.randrange(256) for _ in range(rng.choice([1, 5, 63, 64, 65, 200]))) for _ in "ab")
        import numpy as np

        moved = resampling._moved(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))
        assert int(moved[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_draw(frame, documents):
    docs = documents + [(i, f"Wort{i % 7} é 漢字 " * 12 + "x" * 150) for i in range(100, 160)] + [(120, "twin " * 30)] * 3
    target = ["twin twin twin", None, "", "the Answer IS 42"]
    expected, _ = plain_draw(docs, target)
    rows = frame(docs).selectExpr("*", "1 as weight", "2 as rank", "3 as k0")
    got = resampling.resample(rows, frame([(t,) for t in target], "text string")).drop("n_words")
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected


def test_empty(frame):
    nothing = frame([])
    assert resampling.resample(nothing, nothing).collect() == []
    row = resampling.resample(frame([(1, "a b")]), nothing).collect()
    assert [(r.n_features, r.rank) for r in row] == [(3, None)]


def test_selection_equals_sorting(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 2, 2, 2, rng.randint(0, 9)]), rng.randint(0, 3), i) for i in range(700)]
    frame = spark.createDataFrame(rows, "k0 long, k1 long, k2 long")
    for k in (1, 2, 350, 699, 700):
        assert resampling.kth_key(frame, ["k0", "k1", "k2"], k, pivots=7) == sorted(rows)[k - 1]
    assert resampling.kth_key(frame, ["k0", "k1", "k2"], 0) is None
    places = {(r.k0, r.k1, r.k2): r.rank for r in resampling.ranked(frame, ["k0", "k1", "k2"]).collect()}
    assert places == {r: k for k, r in enumerate(sorted(rows), 1)}


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = queries.op11_resampling(spark, folder).collect()
    assert sorted([tuple(r) for r in got], key=repr) == plain_draw(docs, target)[0]
