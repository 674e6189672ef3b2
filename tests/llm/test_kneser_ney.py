"""The model against a plain one of dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordat.llm import kneser_ney
from concordat.llm.queries import SCORE_TRAIN, op8_scores

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall("".join(c.lower() if c.isascii() else c for c in text or "")), "</s>"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain(docs, order=3):
    """Kneser-Ney by its definition, of n-grams up to `order`: counts at the top, kinds of what goes before below."""
    top, words = Counter(), Counter()
    for i, t in docs:
        if not held(i):
            own = tokens(t)
            words.update(own)
            top.update(grams(own, order))
    n, v = sum(words.values()), len(words)
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    after = {k: Counter() for k in counts}
    kinds = {k: {} for k in counts}
    for k, own in counts.items():
        for g, c in own.items():
            after[k][g[:-1]] += c
            kinds[k].setdefault(g[:-1], Counter())[min(c, 3)] += 1

    def cuts(counts):
        n1, n2, n3, n4 = (sum(c == k for c in counts.values()) for k in (1, 2, 3, 4))
        if min(n1, n2, n3, n4):
            y = n1 / (n1 + 2 * n2)
            found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            if all(0 < d < k + 1 for k, d in enumerate(found)):
                return [0, *found]
        return [0, 0.5, 1.0, 1.5]

    cut = {k: cuts(own) for k, own in counts.items()}

    def chance(g):
        if not g:
            return 1 / (v + 1)
        k, head = len(g), g[:-1]
        if not after[k][head]:
            return chance(g[1:])
        c = counts[k][g]
        spare = sum(cut[k][j] * m for j, m in kinds[k][head].items())
        return (max(c - cut[k][min(c, 3)], 0) + spare * chance(g[1:])) / after[k][head]

    out = []
    for i, t in docs:
        own = tokens(t)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own)
        score = sum(math.log10(chance(g)) for g in grams(own, order))
        out.append((i, held(i), len(own), sum(words[w] > 0 for w in own), n, base, score))
    for head in list(after[order])[:3]:
        total = sum(chance((*head, w)) for w in words) + chance((*head, "never seen"))
        assert abs(total - 1) < 1e-9
    return out


def grams(own, order):
    """The n-grams that end at each token, with starts before the first."""
    full = ["<s>"] * (order - 1) + own
    return zip(*(full[j:] for j in range(order)))


def same(got, expected):
    key = lambda r: (repr(r[0]), r[2], round(r[6], 3))
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=key), sorted(expected, key=key)):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_scores(frame, documents):
    docs = frame(documents).selectExpr("*", "doc_id as batch", "text as held").repartition(5)
    got = kneser_ney.log_probabilities(docs, F.expr(SCORE_TRAIN), batch_words=3000, shard_words=5000)
    same([tuple(r) for r in got.collect()], plain(documents))


@pytest.mark.parametrize("order", [2, 3])
def test_scores_over_parties_of_batches(frame, documents, order):
    """With a fan of 3, a dozen batches or so are merged level by level."""
    docs = frame(documents).repartition(5)
    got = kneser_ney.log_probabilities(docs, F.expr(SCORE_TRAIN), order, batch_words=8000, shard_words=20_000, fan=3)
    same([tuple(r) for r in got.collect()], plain(documents, order))


def test_rows_of_an_exchange_grow_in_proportion(spark):
    """Rows that senders write, counted at two sizes: in proportion to the senders, but for a level more."""

    def rows(batches):
        rng = np.random.default_rng(5)
        written = []

        def send(ranges):
            out = []
            for b in range(batches):
                hashes = np.unique(rng.integers(0, 2**63, 200, np.uint64) * np.uint64(2))
                out += [(b, *x[:1], *x[2:]) for x in kneser_ney._sent(b, hashes, np.ones((len(hashes), 1), np.int64), ranges)]
            written.append(len(out))
            frame = spark.createDataFrame([(k, b, bytearray(h), bytearray(v)) for b, k, h, v in out], kneser_ney.BLOB)
            return frame.repartition(4)

        found = kneser_ney.exchange(send, batches, batches, 1, 4, "rows")
        assert found.where("batch >= 0").select("batch").distinct().count() == batches
        return written[0]

    assert rows(40) <= 2.1 * rows(20)


def test_query_and_held_out_gain(spark, folder):
    rows = [tuple(r) for r in op8_scores(spark, folder).collect()]
    same(rows, plain([tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]))
    assert sum(r[6] for r in rows if r[1]) > sum(r[5] for r in rows if r[1])


def test_no_documents_and_no_training(frame):
    assert kneser_ney.log_probabilities(frame([]), F.expr(SCORE_TRAIN)).collect() == []
    got = kneser_ney.log_probabilities(frame([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]


def test_orders_that_are_sorted_with_their_places_are_those_of_the_numbers():
    rng = np.random.default_rng(5)
    for codes in (rng.integers(0, 50, 300), rng.integers(0, 2**62, 300), np.array([7]), np.array([2**62, 0, 2**62])):
        found, at, rank = kneser_ney._distinct(codes)
        assert found.tolist() == np.unique(codes).tolist() and (codes[at] == found).all() and (found[rank] == codes).all()
    near = np.array([5, 3, 2**63 + 1, 4, 2**63], np.uint64)  # differ in the bits that their places take
    for hashes in (near, rng.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2), np.array([9], np.uint64)):
        order, rank = kneser_ney._ranked(hashes)
        assert hashes[order].tolist() == sorted(hashes.tolist()) and order[rank].tolist() == list(range(len(hashes)))


def test_shards_add_up_what_batches_sent_and_name_the_first_as_owner():
    parts = [(np.array([2, 5, 9], np.uint64), np.array([[1, 2], [3, 4], [5, 6]])), (np.array([1, 5, 9], np.uint64), np.array([[7, 8], [9, 1], [2, 3]]))]
    hashes, totals, owner = kneser_ney._summed(parts)
    assert hashes.tolist() == [1, 2, 5, 9] and owner.tolist() == [1, 0, 0, 0]
    assert totals.tolist() == [[7, 8], [1, 2], [12, 5], [7, 9]] and totals.dtype == np.int64
