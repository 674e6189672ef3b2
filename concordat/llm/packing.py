"""Packing by lexical retrieval: windows filled with the nearest unused documents.

A document longer than a window is cut into full windows and a tail. Tails are dealt to shards
by what they say, wherever they lie in the input: document frequencies are counted over all
tails, a tail's BM25 weights are hashed to a vector, and tails are ordered by the two nearest
of the centres of a bounded sample, then by a term that texts of like rare terms are likely to
share. Runs of that order are the shards. The runs are cut at bounds taken from the sample, and
a run that is too long is cut again, so a shard is bounded, whatever the table's size, and so
are copies of one text. Neither the order nor the bounds depend on how the input is split.

Each shard has a BM25 inverted index of its tails. The first unused tail is the seed of a
window; the index returns its unused neighbours, best first, which fill the window; the last
one is cut where the window ends and its rest stays unused. When no neighbour is left, the next
unused tails follow. What is left of a shard at the end fills windows of powers of two, which
need no padding.

Texts are encoded once and their ids written; tails are shuffled once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, pieces, small_batches, written
from .tokens import encoder

K1, B = 1.2, 0.75
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
DIMENSIONS, CENTRES, SAMPLE, PARTS = 512, 128, 8192, 1024


def _mixed(terms: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each term."""
    h = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def grams(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different terms of all lists, list by list in ascending order: term, number of its list, times in it."""
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    terms = np.concatenate(lists) if lists else owner
    both, times = np.unique(owner << 32 | terms.astype(np.int64), return_counts=True)
    return both & 0xFFFFFFFF, both >> 32, times


class Deal:
    """Gives each token list its key in an order where like lists lie together, and its run of that order.

    `df` has the number of lists that hold each term, `sample` the lists, with a hash of each,
    from which centres and bounds are taken.
    """

    def __init__(self, df: np.ndarray, rows: int, mean: float, sample: list[tuple[np.ndarray, int]], parts: int):
        self.mean = max(mean, 1e-9)
        self.idf = np.log1p((rows - df + 0.5) / (df + 0.5)).astype(np.float32)
        hashes = _mixed(np.arange(len(df)))
        self.bucket = (hashes >> np.uint64(55)).astype(np.int64) % DIMENSIONS
        self.sign = np.where(hashes >> np.uint64(54) & np.uint64(1), 1, -1).astype(np.float32)
        # The least of these among a list's terms is a draw weighted by idf; a term of one list is never drawn.
        draw = (_mixed(hashes) >> np.uint64(11)).astype(float) / 2**53
        self.rank = np.argsort(np.argsort(np.where(df > 1, -np.log(draw + 1e-300) / np.maximum(self.idf, 1e-9), np.inf), kind="stable"))
        self.centres = np.zeros((1, DIMENSIONS), np.float32)
        self.bounds: list[tuple[int, int]] = []
        if parts > 1 and sample:
            sample = sorted(sample, key=lambda x: (x[1], x[0].tobytes()))
            lists = [x[0] for x in sample]
            self.centres = self._centres(self.vectors(lists))
            keys = sorted(zip(self.keys(lists), (x[1] for x in sample)))
            self.bounds = sorted({keys[len(keys) * i // parts] for i in range(1, parts)})

    def vectors(self, lists: list[np.ndarray]) -> np.ndarray:
        """The BM25 weights of each list, hashed, at length one."""
        term, owner, times = grams(lists)
        norm = K1 * (1 - B + B * np.array([len(x) for x in lists]) / self.mean)
        weight = self.idf[term] * times * (K1 + 1) / (times + norm[owner]) * self.sign[term]
        made = np.bincount(owner * DIMENSIONS + self.bucket[term], weight, len(lists) * DIMENSIONS).reshape(len(lists), DIMENSIONS)
        return (made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def _centres(self, vectors: np.ndarray) -> np.ndarray:
        """Centres of `vectors` by spherical k-means, those of like place next to each other."""
        rng = np.random.default_rng(1)
        made = vectors[rng.choice(len(vectors), min(CENTRES, -(-len(vectors) // 16)), False)]
        for _ in range(8):
            nearest = (vectors @ made.T).argmax(1)
            sums = np.stack([vectors[nearest == j].sum(0) if (nearest == j).any() else c for j, c in enumerate(made)])
            made = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)

        def halved(at: np.ndarray) -> list[int]:
            if len(at) < 2:
                return at.tolist()
            own = made[at] - made[at].mean(0)
            at = at[np.argsort(own @ np.linalg.svd(own, full_matrices=False)[2][0], kind="stable")]
            return halved(at[: len(at) // 2]) + halved(at[len(at) // 2 :])

        return made[halved(np.arange(len(made)))]

    def keys(self, lists: list[np.ndarray]) -> list[int]:
        """Nearest centre, second nearest, and a term, as one number."""
        score = self.vectors(lists) @ self.centres.T
        rows = np.arange(len(lists))
        first = score.argmax(1)
        score[rows, first] = -np.inf
        term = np.array([self.rank[x].min() for x in lists], np.int64)
        return (first.astype(np.int64) << 48 | score.argmax(1).astype(np.int64) << 40 | term).tolist()

    def part(self, key: int, salt: int) -> int:
        return bisect_right(self.bounds, (key, salt))


class Bm25:
    """An inverted index of token lists, with the BM25 weight of each posting.

    `terms`, where given, bounds the terms of a seed that are looked up, rarest of the shared first.
    """

    def __init__(self, lists: list[np.ndarray], terms: int | None = None):
        self.terms = terms
        sizes = np.array([len(x) for x in lists], float)
        term, owner, times = grams(lists)
        self.vocabulary, place, df = np.unique(term, return_inverse=True, return_counts=True)
        self.idf = np.log1p((len(lists) - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / max(sizes.mean(), 1e-9)) if len(sizes) else sizes
        weight = self.idf[place] * times * (K1 + 1) / (times + norm[owner]) if len(term) else times
        order = np.argsort(place, kind="stable")
        # Terms of an eighth of the documents or more are rows of a table, as theirs are most postings; the others have lists.
        self.df, common = df, np.flatnonzero(df >= max(2, len(lists) / 8))
        self.row = np.full(len(df), -1)
        self.row[common] = np.arange(len(common))
        self.table = np.zeros((len(common), len(lists)), np.float32)
        often = self.row[place] >= 0
        self.table[self.row[place[often]], owner[often]] = weight[often]
        order = order[~often[order]]
        self.owner, self.weight = owner[order], weight[order].astype(np.float32)
        self.ends = np.concatenate([[0], np.cumsum(np.where(self.row >= 0, 0, df))])
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lists)))])
        self.place = place

    def shrink(self, unused: np.ndarray) -> None:
        """Leave out the postings of documents that are used up. Weights stay as they were over all documents."""
        keep = unused[self.owner]
        self.ends = np.concatenate([[0], np.cumsum(keep)])[self.ends]
        self.owner, self.weight = self.owner[keep], self.weight[keep]

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a term with the seed, best full BM25 score first, then by position.

        A window takes a few of them, so those after the best are sorted when they are asked for.
        """
        own = self.place[self.starts[seed] : self.starts[seed + 1]]
        own = own[self.df[own] > 1]  # a term of the seed alone finds nothing
        if self.terms is not None and len(own) > self.terms:
            own = own[np.argsort(-self.idf[own], kind="stable")[: self.terms]]
        if not len(own):
            return
        row = self.row[own]
        score = self.table[row[row >= 0]].sum(0).astype(float)
        own = own[row < 0]
        if len(own):
            spans = [slice(a, b) for a, b in zip(self.ends[own].tolist(), self.ends[own + 1].tolist())]
            owner, weight = (np.concatenate([x[span] for span in spans]) for x in (self.owner, self.weight))
            score += np.bincount(owner, weight, len(unused))
        found = np.flatnonzero((score > 0) & unused)
        if len(found) > 64:
            own = score[found]
            best = own >= np.partition(own, -32)[-32]
            yield from found[best][np.argsort(-own[best], kind="stable")].tolist()
            found = found[~best]
        yield from found[np.argsort(-score[found], kind="stable")].tolist()


def fill(tails: list[np.ndarray], window: int, terms: int | None = None) -> list[list[tuple[int, int, int]]]:
    """Windows over `tails` as lists of (tail, start in it, length); each position is used once.

    All windows are full but for those at the end, whose lengths are distinct powers of two.
    """
    index = Bm25(tails, terms)
    left = np.array([len(t) for t in tails], np.int64)
    at = np.zeros(len(tails), np.int64)
    unused = left > 0
    total, seed, windows = int(left.sum()), 0, []
    held = len(tails)
    while total > 0:
        if (open_ := int(unused.sum())) <= 0.5 * held:
            index.shrink(unused)
            held = open_
        size = window if total >= window else 1 << (total.bit_length() - 1)
        total -= size
        while not unused[seed]:
            seed += 1
        row, room, near, nxt = [], size, None, seed
        item = seed
        while True:
            n = int(min(room, left[item]))
            row.append((item, int(at[item]), n))
            at[item] += n
            left[item] -= n
            unused[item] = left[item] > 0
            room -= n
            if not room:
                break
            if near is None:
                near = index.neighbours(seed, unused)
            item = next(near, -1)
            if item < 0:
                while not unused[nxt]:
                    nxt += 1
                item = nxt
        windows.append(row)
    return windows


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = 1024, shard_rows: int = 2048, terms: int | None = None,
    joins_space: bool = True, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    `ids` are the piece's token ids as little-endian unsigned 32-bit integers. Each row of
    `docs` is a document of its own, also where ids are null or repeated. A null text is
    empty and holds its end id only. Every id of every document lies in exactly one piece.
    A shard has about `shard_rows` tails, and under twice as many.
    All terms of a seed are looked up, or the `terms` rarest that it shares within its shard.
    """

    def batch(rows: list[tuple], kinds: list = KINDS, names: list[str] = NAMES) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in names]
        found = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)
        rows.clear()
        return found

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Full windows, which have an offset, and tails, which have none yet; even sequence ids."""
        serial = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []
        for part in pieces(stream):
            blobs = encoder(tokenizer, joins_space).encode(part.column("text").to_pylist())
            for doc, blob in zip(part.column("doc_id").to_pylist(), blobs):
                blob += end
                total = len(blob) // 4
                for start in range(0, total, window):
                    n = min(window, total - start)
                    rows.append((doc, start, n, blob[4 * start : 4 * (start + n)], total, serial, 0 if n == window else None))
                    serial += 2
                if len(rows) >= 4096:
                    yield batch(rows)
        yield batch(rows)

    def lists(part: pa.RecordBatch) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4") for x in part.column("ids").to_pylist()]

    def frequencies(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(term, n): how many tails hold a term; under -1 the number of tails, under -2 that of their ids."""
        found, seen, size = np.zeros(0, np.int64), 0, 0
        for part in stream:
            own = lists(part)
            if not own:
                continue
            seen, size = seen + len(own), size + sum(map(len, own))
            more = np.bincount(grams(own)[0], minlength=len(found))
            more[: len(found)] += found
            found = more
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *at.tolist()], pa.int64()), pa.array([seen, size, *found[at].tolist()], pa.int64())], ["term", "n"])

    held = written(
        small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, SCHEMA), "pieces"
    )
    tails = held.where("offset is null")
    counts = {r.term: r.n for r in tails.select("ids").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    count, size = counts.pop(-1, 0), counts.pop(-2, 0)
    df = np.zeros(max(counts, default=0) + 1, np.int64)
    df[list(counts)] = list(counts.values())
    parts = min(PARTS, -(-count // shard_rows))
    salt = F.xxhash64("doc_id", "ids")
    sample = []
    if parts > 1:
        some = tails.where(F.pmod(F.xxhash64("ids", "doc_id"), F.lit(1 << 30)) < int(min(1, SAMPLE / count) * (1 << 30)))
        sample = [(np.frombuffer(r.ids, "<u4"), r.salt) for r in some.select("ids", salt.alias("salt")).limit(2 * SAMPLE).collect()]
    deal = Deal(df, count, size / max(count, 1), sample, parts)

    def place(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in stream:
            if part.num_rows:
                keys = deal.keys(lists(part))
                runs = [deal.part(*x) for x in zip(keys, part.column("salt").to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.int64()), pa.array(runs, pa.int64())], [*part.schema.names, "key", "part"])

    def settle(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of runs that follow each other; odd sequence ids."""
        tails: list[tuple] = []
        rows: list[tuple] = []
        run, serial = None, 0

        def shard(size: int) -> None:
            nonlocal serial
            own = tails[:size]
            for row in fill([t[3] for t in own], window, terms):
                offset = 0
                for item, start, n in row:
                    doc, begin, total, ids = own[item]
                    rows.append((doc, begin + start, n, ids[start : start + n].tobytes(), total, (run << 40) + serial, offset))
                    offset += n
                serial += 2
            del tails[:size]

        for part in stream:
            columns = (part.column(x).to_pylist() for x in ("part", "doc_id", "start", "doc_tokens"))
            for now, doc, start, total, ids in zip(*columns, lists(part)):
                if now != run:
                    shard(len(tails))
                    run, serial = now, 1
                tails.append((doc, start, total, ids))
                if len(tails) >= 2 * shard_rows:
                    shard(shard_rows)
                if len(rows) >= 4096:
                    yield batch(rows)
        shard(len(tails))
        yield batch(rows)

    kept = "doc_id long, start long, doc_tokens long, ids binary, sequence_id long, salt long"
    dealt = tails.select("doc_id", "start", "doc_tokens", "ids", "sequence_id", salt.alias("salt")).mapInArrow(place, f"{kept}, key long, part long")
    dealt = dealt.repartition(partitions(docs.sparkSession), "part").sortWithinPartitions("part", "key", "salt", "sequence_id")
    return held.where("offset is not null").unionAll(dealt.mapInArrow(settle, SCHEMA))
