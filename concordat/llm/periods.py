"""Runs of repeated words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period q, at least `least_repeats` times q long, that
no neighbour extends. For each power of two L, every stretch of L words (a basic factor) has a
name; equal stretches have one name, built from the names of their two halves. From each place the
dictionary gives the next place of the same name, if it is L words away or less, so that both lie
within 2L words. Successors that stay equally far apart from place to place form an arithmetic
progression; their distance is a proposed period.

A period q is looked for with the smallest L that is at least q. In a run of length 4q the factor of a place
returns first after q words, since a stretch of q or more words fixes its place in the period. So
the places of a progression, extended by the L words of the factor and by q, are a whole run: a
place before or after it in the run would be of the same progression. Each run is so proposed by one L only; what
smaller distances propose at a larger L is the same runs again and is left out.

All texts of a batch are named together, words that recur nowhere near are dropped before the next
power, and numpy sorts what is left, so most texts cost one round. A name's text is part of it: no
stretch reaches over the end of a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, small_batches

RUN = "struct<start:long,length:long,period:long>"


def _names(values: np.ndarray) -> np.ndarray:
    """Small numbers for equal values."""
    order = np.argsort(values, kind="stable")
    step = np.empty(len(values), np.int64)
    step[order] = np.concatenate([[0], np.cumsum(np.diff(values[order]) != 0)]) if len(values) else 0
    return step


def _progressions(place: np.ndarray, name: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Successors of factors of `size` words at ascending places.

    Returns first place, last place and distance of each progression, and which places have an equal factor near enough
    that a longer period may still follow from it.
    """
    order = np.argsort(name, kind="stable")
    here, there = order[:-1], order[1:]
    same = name[here] == name[there]
    again = np.zeros(len(place), bool)
    again[here[same]] = again[there[same]] = True
    gap = place[there] - place[here]
    near = same & (gap <= size) & (2 * gap > size)
    at, by = place[here[near]], gap[near]
    order = np.argsort(at, kind="stable")
    at, by = at[order], by[order]
    if not len(at):
        return at, at, by, again
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(by) != 0)])
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(at)]]) - 1
    return at[heads], at[tails], by[heads], again


def find_runs(words: np.ndarray, text: np.ndarray, least_length: int, least_repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, length, period) of all runs of `words` (numbers of words) that lie in one `text` (ascending numbers).

    Ordered by place, then period. `least_repeats` is 4 or more, on which the choice of L rests.
    """
    if least_repeats < 4:
        raise ValueError("a run repeats at least four times")
    place = np.arange(len(words))
    name = _names(text * (int(words.max(initial=0)) + 1) + words)
    found, size = [], 1
    while len(place):
        first, last, period, again = _progressions(place, name, size)
        length = last - first + size + period
        long_enough = length >= np.maximum(least_length, least_repeats * period)
        found.append((first[long_enough], length[long_enough], period[long_enough]))
        # A factor of twice the size that recurs consists of two that do, `size` apart.
        held = np.full(len(words) + size, -1)
        held[place[again]] = name[again]
        second = held[place + size]
        both = again & (second >= 0)
        place, second, name = place[both], second[both], name[both]
        inside = text[np.minimum(place + 2 * size - 1, len(words) - 1)] == text[place] if len(place) else both[:0]
        inside &= place + 2 * size <= len(words)
        place = place[inside]
        name = _names(name[inside] * (int(second.max(initial=0)) + 1) + second[inside])
        size *= 2
    first, length, period = (np.concatenate(x) if found else np.empty(0, np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    order = np.lexsort((period, first))
    return first[order], length[order], period[order]


def repeat_tail(words: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The places whose words stand in a text's places: in one text of ten, told by its id, the words from some place
    on are a few of them over and over. A null id changes nothing."""
    n = len(words)
    place = np.arange(n)
    if doc_id is None or not n:
        return place
    told = zlib.crc32(str(doc_id).encode())
    if told % 10:
        return place
    g = told // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place[a:] = a + np.arange(n - a) % p
    return place


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


def collapse_runs(
    docs: DataFrame, least_length: int = 6, least_repeats: int = 4, rewrite=None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of `docs`.

    Words are separated by ASCII white space. `runs` holds (start, length, period), by start, then period; starts count words from 0.
    `collapsed` is the text's words, one space between, without those that any run contains after its first period. `rewrite`,
    given a text's word numbers and id, returns which place's word stands at each place (see `repeat_tail`). A null text has no words, no
    runs and collapses to the empty text; a repeated row is returned as often. A text is worked on whole in one task, with about a
    hundred bytes a word.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(stream, 4 << 20):
            ids = batch.column("doc_id").to_pylist()
            known = _Numbers()
            said = [t.encode("utf-8", "replace").split() if t else [] for t in batch.column("text").to_pylist()]
            numbers = [np.fromiter(map(known.__getitem__, x), np.int64, len(x)) for x in said]
            if rewrite:
                for i, own in enumerate(ids):
                    at = rewrite(numbers[i], own)
                    if len(at) and not np.array_equal(at, np.arange(len(at))):
                        numbers[i], said[i] = numbers[i][at], [said[i][j] for j in at.tolist()]
            sizes = np.fromiter(map(len, said), np.int64, len(said))
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            owner = np.repeat(np.arange(len(said)), sizes)
            first, length, period = find_runs(np.concatenate(numbers) if numbers else np.empty(0, np.int64), owner, least_length, least_repeats)
            cover = np.zeros(int(bounds[-1]) + 1, np.int64)
            np.add.at(cover, first + period, 1)
            np.add.at(cover, first + length, -1)
            dropped = np.cumsum(cover[:-1]) > 0
            has = np.unique(owner[first]).tolist()
            for i in has:
                gone = dropped[bounds[i] : bounds[i + 1]].tolist()
                said[i] = [w for w, g in zip(said[i], gone) if not g]
            per = np.searchsorted(first, bounds)
            flat = pa.StructArray.from_arrays(
                [pa.array(first - bounds[owner[first]]), pa.array(length), pa.array(period)], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(per.astype(np.int32)), flat),
                    pa.array([b" ".join(x).decode("utf-8") for x in said], pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    own = small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def run_digests(rows: DataFrame) -> DataFrame:
    """Count, longest run and digests of rows as `collapse_runs` returns them."""
    # The greatest length, then the smallest start and period.
    order = F.transform("runs", lambda r: F.struct((-r.length).alias("far"), r.start.alias("start"), r.period.alias("period")))
    best = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    told = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    length = -F.col("best.far")
    return told.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
