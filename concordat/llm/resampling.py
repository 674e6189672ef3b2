"""Importance resampling: documents drawn so that the draw resembles a target corpus.

Features are runs of one to `longest` words, hashed to `buckets` buckets by CRC-32. Spark counts
the buckets of the source and of the target; the log ratio of the two smoothed shares is a
bucket's gain, and a document's weight is the sum of the gains of its features, read from one
array of `buckets` numbers. Weight plus Gumbel noise, which hangs on the document's id alone, is its score: the
highest scores are a draw without replacement in proportion to the weights' exponentials.

The draw is a distributed quickselect. Rows are ordered by a composite key that ends in a row
number, so no two are equal. Each round takes a few random keys of the rows still open as pivots, counts
the rows before, at and after each of them exactly, and goes on between the two pivots that
enclose the k-th row, until that row is a pivot itself. Only the rows up to it are sorted, by
range, and ranked.

CRC-32 is linear: the checksum of a run is that of the run without its last word, moved on by
the word's length, xor the word's own. So runs are never built; numpy works on the words' checksums.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, partitions, pieces, small_batches, written

# A word, once A-Z are lower-cased; all bytes of a longer character are of a word.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# Zero bytes that one table moves a checksum over; longer words take several steps.
REACH = 64
# Distinct words a worker keeps the checksums of.
KEPT = 1_000_000


def _moves() -> np.ndarray:
    """moves[n, k, b]: what byte k of value b of a checksum becomes when n zero bytes follow."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1).astype(np.uint32)
    out = np.empty((REACH + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, REACH + 1):
        out[n] = (out[n - 1] >> 8) ^ byte[out[n - 1] & 0xFF]
    return out.reshape(-1)


_MOVES = _moves()
_ONE = _MOVES[1024 : 1024 + 256]
_SPACE = np.uint32(zlib.crc32(b" "))


def _moved(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The checksums as they are when so many zero bytes follow."""
    at = np.minimum(lengths, REACH) * 1024
    byte = sums.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    out = _MOVES[at + byte[:, 0]]
    for k in (1, 2, 3):
        out ^= _MOVES[at + (byte[:, k].astype(np.int64) + 256 * k)]
    far = np.flatnonzero(lengths > REACH)
    if len(far):
        out[far] = _moved(out[far], lengths[far] - REACH)
    return out


class _Words(dict):
    """word -> its number in this worker; checksums and lengths by number."""

    def __init__(self):
        super().__init__()
        self.sums, self.lengths = [], []

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.sums)
        self.sums.append(zlib.crc32(word))
        self.lengths.append(len(word))
        return at


_KNOWN = _Words()


def feature_buckets(texts: list[str | None], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each run length: buckets of all runs, in order; the text each is of; first the words of each text."""
    global _KNOWN
    if len(_KNOWN) > KEPT:
        _KNOWN = _Words()
    found = [_WORD.findall(t.encode("utf-8", "replace").lower()) if t else [] for t in texts]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    numbers = np.fromiter(map(_KNOWN.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
    own = np.array(_KNOWN.sums, np.uint32)[numbers]
    length = np.array(_KNOWN.lengths, np.int64)[numbers]
    text = np.repeat(np.arange(len(found)), sizes)
    yield sizes, (own % np.uint32(buckets)).astype(np.int64), text
    run = own
    for n in range(2, longest + 1):
        if len(run) < 2:
            return
        spaced = (run[:-1] >> np.uint32(8)) ^ _ONE[run[:-1] & np.uint32(0xFF)] ^ _SPACE
        run = _moved(spaced, length[n - 1 :]) ^ own[n - 1 :]
        inside = text[n - 1 :] == text[: len(text) - n + 1]
        yield sizes, (run[inside] % np.uint32(buckets)).astype(np.int64), text[n - 1 :][inside]


def bucket_counts(rows: DataFrame, text: str = "text", longest: int = 3, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how often features fall in each bucket that any does. Each task adds up its own; nulls have none."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces(stream):
            for _, found, _ in feature_buckets(batch.column(0).to_pylist(), longest, buckets):
                total += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    counted = small_batches(rows).select(F.col(text).alias("text")).mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = 10_000) -> list[int]:
    """Each bucket's gain in thousandths, from counts as `bucket_counts` returns them: `buckets` rows of either at most."""
    s, t = (dict(x.select("bucket", "n").collect()) for x in (source, target))
    of_s, of_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [
        math.floor(1000 * math.log((float(t.get(b, 0) + 1) * of_s) / (float(s.get(b, 0) + 1) * of_t)))
        for b in range(buckets)
    ]


def weigher(gain: list[int], longest: int = 3):
    """A function of a text column: struct (n_words, n_features, weight) of longs; zeros for a null and for no word."""
    array = np.array(gain, np.int64)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(text):
        import pandas as pd

        out = np.zeros((len(text), 3), np.int64)
        step = 200  # texts worked on at a time: their features lie in memory at once
        for low in range(0, len(text), step):
            part = out[low : low + step]
            for sizes, found, own in feature_buckets(text.iloc[low : low + step].tolist(), longest, len(array)):
                part[:, 0] = sizes
                part[:, 1] += np.bincount(own, minlength=len(part))
                before = np.concatenate([[0], np.cumsum(array[found])])
                ends = np.searchsorted(own, np.arange(len(part) + 1))
                part[:, 2] += before[ends[1:]] - before[ends[:-1]]
        return pd.DataFrame(out, columns=["n_words", "n_features", "weight"])

    return weigh


def noise(doc_id: Column, seed: int = 42) -> Column:
    """Gumbel noise in thousandths, from the SHA-256 of `<seed>:<id>`; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def kth_key(rows: DataFrame, keys: list[str], k: int, pivots: int = 31) -> tuple[int, ...] | None:
    """The k-th least of the composite keys (long columns, no nulls, no two rows alike); None for k = 0.

    What comes to the driver is `pivots` keys and 2 * `pivots` + 1 counts a round. Of the rows still open a round keeps
    about one in `pivots` / 2, so rounds grow with the logarithm of the rows.
    """
    if k < 1:
        return None
    key = F.struct(*keys)
    literal = lambda values: F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(keys, values)])
    low = high = None
    turn = 0
    while True:
        open_ = rows
        if low is not None:
            open_ = open_.where((F.col(keys[0]) >= low[0]) & (key > literal(low)))
        if high is not None:
            open_ = open_.where((F.col(keys[0]) <= high[0]) & (key < literal(high)))
        drawn = open_.orderBy(F.xxhash64(F.lit(turn), *keys), *keys).select(*keys).limit(pivots).collect()
        found = sorted(tuple(r) for r in drawn)
        # An even slot lies before its pivot, an odd one is a pivot.
        bounds = F.array(*map(literal, found))
        slot = F.size(F.filter(bounds, lambda p: key >= p)) + F.size(F.filter(bounds, lambda p: key > p)) if found else F.lit(0)
        counts = dict(open_.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).collect())
        at = 0
        while k > counts.get(at, 0):
            k -= counts.get(at, 0)
            at += 1
        if at % 2:
            return found[at // 2]
        low = found[at // 2 - 1] if at else low
        high = found[at // 2] if at // 2 < len(found) else high
        turn += 1


def ranked(rows: DataFrame, keys: list[str], name: str = "rank") -> DataFrame:
    """`rows` with their place by `keys`, from 1: sorted by range, each range counted, and the ranges' sizes added up."""
    sort = rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    part, place = free_name(rows, "part"), free_name(rows, "place")
    at = F.monotonically_increasing_id()
    held = written(sort.withColumns({part: F.shiftright(at, 33), place: at.bitwiseAND(F.lit((1 << 33) - 1))}), "ranges")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = held.groupBy(part).agg(F.count("*").alias("n"))
    bases = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    return held.join(bases, part).withColumn(name, (F.col("n") + F.col(place) + 1).cast("long")).drop(part, place, "n")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, longest: int = 3, buckets: int = 10_000,
    seed: int = 42, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of `docs`.

    `percent` of the rows with `least_words` words or more are drawn, the count rounded down, and ranked; the others' rank is null. Equal
    scores go by id, a null id last, then by number of features, then by place in the input: rows that tie so far look
    alike. A null text has no words, features or weight; a text of any length is worked on whole. Without a target all gains
    follow from the source alone; without rows nothing is returned.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    told = small_batches(docs).select(F.col(doc_id).alias("doc_id"), weigher(gain, longest)(F.col(text)).alias("w"))
    told = told.select("doc_id", "w.*", (F.col("w.weight") + noise(F.col("doc_id"), seed)).alias("score"))
    order = {
        "k0": -F.col("score"), "k1": F.col("doc_id").isNull().cast("long"), "k2": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        "k3": F.col("n_features"), "k4": F.monotonically_increasing_id(),
    }
    held = written(told.withColumns(order), "scored")
    keys = list(order)
    able = held.where(F.col("n_words") >= least_words)
    last = kth_key(able, keys, able.count() * percent // 100)
    if last is None:
        return held.select("doc_id", "n_words", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    limit = F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(keys, last)])
    drawn = able.where((F.col("k0") <= last[0]) & (F.struct(*keys) <= limit)).select(*keys)
    places = ranked(drawn, keys).select("k4", "rank")
    return held.join(places, "k4", "left").select("doc_id", "n_words", "n_features", "weight", "score", "rank")
