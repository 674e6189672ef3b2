"""Interpolated modified Kneser-Ney trigram model, and the log probability of every text under it.

Documents are read in batches of a bounded number of words. A batch knows its distinct words,
word pairs and triples by 64-bit hashes. Counting is an exchange, one for each order, the
highest first: a batch sends, for ranges of hashes, the sorted hashes it has and its training
counts of them; a task of a range adds them up to a shard of the model, a pair of sorted arrays
(hash, count) in a memory-mapped scratch file, and looks up for each batch the totals of its
hashes. So only packed arrays are shuffled, each batch gets the part of the model that it needs,
and no worker holds the whole model, which grows with the corpus.

Up to `fan` batches write to all ranges, which are then as many as the words need, or as there
are shuffle partitions. Where there are more batches, each writes to `fan` ranges only, and
parties of `fan` batches are merged range by range, the merged arrays are exchanged like batches
of their own, over finer ranges, and what comes back is dealt to the members. So the rows of a
level are batches times `fan` or so, and the levels are the logarithm of the batches.

    order 3   c(u v w) of all training texts
    order 2   N1+(. v w), the kinds of triples that end so
    order 1   N1+(. w), the kinds of pairs that end so; and c(w), for the add-one model
    each order below the highest also has, of the n-grams that begin so, their sum and N1, N2, N3+
    score     p(w | h) = max(c(h w) - D(c), 0) / c(h .) + g(h) p(w | h without its first word)
              p(w)     = max(N1+(. w) - D(N1+), 0) / N1+(. .) + g / (V + 1)

Each distinct n-gram has one batch that owns it, which counts it for the order below. A text is
its words and an end; before it stand as many starts as the first word's history needs.
Discounts come from counts of counts; where these give none, 0.5, 1 and 1.5 are taken. A word
never seen has the share of one more word of the vocabulary. All of a shard's numbers fit a
task, since ranges are cut by the number of words of the corpus.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, pieces, small_batches, written, written_in_buckets

START, END = 0, 1  # numbers of the two marks in every batch
MARKS = [b" start", b" end"]  # no word holds a space
BLOB = "bucket int, batch long, hashes binary, values binary"
STATE = "batch long, doc_ids array<long>, held array<boolean>, sizes array<int>, n_words long, words binary, tokens binary"


def packed(array: np.ndarray) -> bytes:
    """An array by byte planes, compressed."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(array.size, -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    planes = raw.reshape(np.dtype(kind).itemsize, -1).T
    return np.ascontiguousarray(planes).view(kind).reshape(-1)


def packed_sorted(hashes: np.ndarray) -> bytes:
    return packed(np.diff(hashes, prepend=np.uint64(0)))


def unpacked_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, np.uint64), dtype=np.uint64)


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(31)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


def encode(docs: DataFrame, train: Column, batch_words: int, doc_id: str, text: str) -> DataFrame:
    """One row per batch: its documents, its distinct words' hashes, and its texts as numbers of words."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = 0

        def row() -> pa.RecordBatch:
            nonlocal serial
            number = (TaskContext.get().partitionId() << 32) | serial
            serial += 1
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
            tokens = np.concatenate([np.array(x, np.uint32) for x in texts])
            values = [number, ids, held, [len(x) for x in texts], len(tokens), packed(hashes), packed(tokens)]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
            names = ["batch", "doc_ids", "held", "sizes", "n_words", "words", "tokens"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        def fresh() -> None:
            nonlocal known, ids, held, texts, size
            known, ids, held, texts, size = {w: i for i, w in enumerate(MARKS)}, [], [], [], 0

        known: dict[bytes, int]
        ids: list
        held: list
        texts: list
        size: int
        fresh()
        for batch in pieces(stream):
            for i, t, h in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "held"))):
                learn = known.setdefault
                numbers = [learn(w, len(known)) for w in (t or "").encode("utf-8", "replace").lower().split()]
                numbers.append(END)
                ids.append(i)
                held.append(h)
                texts.append(numbers)
                size += len(numbers)
                if size >= batch_words:
                    yield row()
                    fresh()
        if ids:
            yield row()

    # A null condition (a null id) is not held out.
    own = small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(~train, F.lit(False)).alias("held"))
    return own.mapInArrow(run, STATE)


@dataclass
class Grams:
    """A batch's distinct n-grams of one order, by ascending hash, and for each of its tokens the n-gram that ends there."""

    hashes: np.ndarray
    place: np.ndarray
    start: int  # the n-gram of starts alone
    head: np.ndarray | None = None  # in the order below: without the last word
    tail: np.ndarray | None = None  # in the order below: without the first word


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers, ascending, for each a place where it stands, and for each place its number's rank.

    Numbers that leave room for their places are sorted with these as one; that is many times faster than an order.
    """
    bits = max(1, (len(codes) - 1).bit_length())
    if int(codes.max()) >> (63 - bits):
        order = np.argsort(codes)
    else:
        order = np.sort(codes << bits | np.arange(len(codes))) & ((1 << bits) - 1)
    ranked = codes[order]
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    rank = np.empty(len(codes), np.int32)
    rank[order] = np.cumsum(fresh) - 1
    return ranked[fresh], order[fresh], rank


def _ranked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = max(1, (len(hashes) - 1).bit_length())
    low = np.uint64((1 << bits) - 1)
    order = (np.sort(hashes & ~low | np.arange(len(hashes), dtype=np.uint64)) & low).astype(np.int32)
    ranked = hashes[order]
    if (ranked[1:] < ranked[:-1]).any():  # two that differ in their last bits only
        order = np.argsort(hashes).astype(np.int32)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return order, rank


class Batch:
    """The arrays of one batch, and its distinct n-grams of the orders 1 to `order`."""

    def __init__(self, row: dict, order: int):
        self.ids, self.held = row["doc_ids"], np.array(row["held"], bool)
        self.sizes = np.array(row["sizes"], np.int64)
        words, tokens = unpacked(row["words"], np.uint64), unpacked(row["tokens"], np.uint32)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.learnt = ~self.held[self.doc]
        first = np.cumsum(self.sizes) - self.sizes
        place, rank = _ranked(words)
        self.grams = [Grams(words[place], rank[tokens], int(rank[START]))]
        one = self.grams[0]
        n = len(words)
        for k in range(2, order + 1):
            low = self.grams[-1]
            before = np.empty(len(low.place), np.int64)
            before[1:] = low.place[:-1]
            before[first] = low.start
            code, at, place = _distinct(np.append(before * n + one.place, low.start * n + one.start))
            hashes = pair_hash(low.hashes[code // n], one.hashes[code % n])
            own, rank = _ranked(hashes)
            tail = np.append(low.place, np.int32(low.start))[at]
            self.grams.append(Grams(hashes[own], rank[place[:-1]], int(rank[place[-1]]), (code // n).astype(np.int32)[own], tail[own]))

    def counts(self, order: int) -> np.ndarray:
        own = self.grams[order - 1]
        return np.bincount(own.place[self.learnt], minlength=len(own.hashes))

    def columns(self, order: int, above: np.ndarray | None) -> np.ndarray:
        """What the batch knows of its n-grams of `order`, given (count, owned) of those of the order above."""
        if above is None:
            return self.counts(order)[:, None]
        high, n = self.grams[order], len(self.grams[order - 1].hashes)
        mine = (above[:, 1] == 1) & (above[:, 0] > 0)
        head, tail, c = high.head[mine], high.tail[mine], above[mine, 0]
        columns = [np.bincount(tail, minlength=n), np.bincount(head, c, n)]
        columns += [np.bincount(head[pick], minlength=n) for pick in (c == 1, c == 2, c > 2)]
        if order == 1:
            columns.append(self.counts(1))
        return np.column_stack(columns).astype(np.int64)


def _sent(number: int, hashes: np.ndarray, values: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Sorted hashes with their values (a column for each kind), a row for each range of hashes that has any."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    own, first = np.unique(bucket, return_index=True)
    for b, low, high in zip(own, first, [*first[1:], len(hashes)]):
        yield int(b), number, packed_sorted(hashes[low:high]), packed(values[low:high].astype(np.uint64))


def _rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that one batch's arrays are held at a time."""
    for batch in stream:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["bucket", "batch", "hashes", "values"])


class Shard:
    """Sorted hashes and their totals in a memory-mapped scratch file, which goes with the task."""

    def __init__(self, hashes: np.ndarray, totals: np.ndarray):
        self.width = totals.shape[1]
        self.n = len(hashes)
        self.file = tempfile.TemporaryFile()
        self.file.write(hashes.tobytes())
        self.file.write(np.ascontiguousarray(totals, np.int64).tobytes())
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        self.hashes = np.frombuffer(self.map, np.uint64, self.n)
        self.totals = np.frombuffer(self.map, np.int64, self.n * self.width, self.n * 8).reshape(self.n, self.width)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of all parts, their totals, and for each the first part that has it."""
    every = np.concatenate([h for h, _ in parts])
    order = np.argsort(every, kind="stable")  # which finds the parts' own order
    ranked, values = every[order], np.concatenate([v for _, v in parts])[order]
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    at, again = np.flatnonzero(fresh), np.flatnonzero(~fresh)
    totals, place = values[at], (np.cumsum(fresh) - 1)[again]
    for k in range(totals.shape[1]):
        totals[:, k] += np.bincount(place, values[again, k], len(at)).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), [len(h) for h, _ in parts])
    return ranked[at], totals, owner[order[at]]


def _parts(table: pa.Table, width: int) -> tuple[list[int], list[tuple[np.ndarray, np.ndarray]]]:
    """The batches that sent something, ascending, and what they sent."""
    sent = sorted(zip(*(table.column(c).to_pylist() for c in ("batch", "hashes", "values"))))
    return [b for b, _, _ in sent], [(unpacked_sorted(h), unpacked(v, np.uint64).reshape(-1, width).astype(np.int64)) for _, h, v in sent]


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _answers(rows: DataFrame, width: int) -> DataFrame:
    """For each batch's hashes the totals of all batches, and whether this batch is the first to have the hash.

    Rows of batch -1 hold the shard's own sums: counts of counts of the first column, the columns' sums, the kinds in the last.
    """

    def run(table: pa.Table) -> pa.Table:
        batches, parts = _parts(table, width)
        hashes, totals, owner = _summed(parts)
        shard = Shard(hashes, totals)
        bucket = table.column("bucket")[0].as_py()
        out = []
        for i, (batch, (own, _)) in enumerate(zip(batches, parts)):
            at = np.searchsorted(shard.hashes, own)
            out.append((bucket, batch, b"", packed(np.column_stack([shard.totals[at], owner[at] == i]).astype(np.uint64))))
        sums = np.array([*_count_of_counts(totals[:, 0]), *totals.sum(0), int((totals[:, -1] > 0).sum())])
        out.append((bucket, -1, b"", sums.astype("<i8").tobytes()))
        return pa.Table.from_batches([_table(out)])

    return rows.groupBy("bucket").applyInArrow(run, BLOB)


def exchange(send: Callable[[int], DataFrame], batches: int, buckets: int, width: int, fan: int, name: str, ranges: int = 1) -> DataFrame:
    """The answers to what `send` gives, a function of the number of ranges, for `batches` senders to each of `ranges` ranges."""
    if batches <= fan:
        return written(_answers(send(max(buckets, ranges)), width), name)
    ranges *= fan
    parties = -(-batches // fan)
    party = F.col("bucket").cast("long") * parties + F.pmod(F.xxhash64("batch"), F.lit(parties))
    sent = written(send(ranges).withColumn("party", party), f"{name}-sent")

    def merge(table: pa.Table) -> pa.Table:
        hashes, totals, _ = _summed(_parts(table, width)[1])
        row = (0, table.column("party")[0].as_py(), packed_sorted(hashes), packed(totals.astype(np.uint64)))
        return pa.Table.from_batches([_table([row])])

    merged = written(sent.groupBy("party").applyInArrow(merge, BLOB), f"{name}-merged")

    def send_on(finer: int) -> DataFrame:
        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(stream):
                totals = unpacked(row["values"], np.uint64).reshape(-1, width)
                yield _table(list(_sent(row["batch"], unpacked_sorted(row["hashes"]), totals, finer)))

        return merged.mapInArrow(run, BLOB)

    found = exchange(send_on, parties, buckets, width, fan, name, ranges)

    def deal(members: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = members.column("bucket")[0].as_py()
        batches, parts = _parts(members, width)
        hashes, _, owner = _summed(parts)
        got = sorted(zip(answers.column("bucket").to_pylist(), answers.column("values").to_pylist()))
        totals = np.concatenate([unpacked(v, np.uint64).reshape(-1, width + 1) for _, v in got])
        out = []
        for i, (batch, (own, _)) in enumerate(zip(batches, parts)):
            at = np.searchsorted(hashes, own)
            mine = totals[at]
            mine[:, -1] *= owner[at] == i
            out.append((bucket, batch, b"", packed(mine)))
        return pa.Table.from_batches([_table(out)])

    answers = found.where("batch >= 0").withColumnRenamed("batch", "party")
    dealt = sent.groupBy("party").cogroup(answers.groupBy("party")).applyInArrow(deal, BLOB)
    return written(dealt.unionByName(found.where("batch < 0")), f"{name}-dealt")


def _sums(answers: DataFrame) -> np.ndarray:
    """The shards' sums, added up: one short row for each shard."""

    @F.pandas_udf("array<long>")
    def numbers(blob: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(b, "<i8").tolist() for b in blob])

    rows = answers.where("batch = -1").select(F.posexplode(numbers("values")).alias("k", "v"))
    found = rows.groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
    return np.array([r["v"] for r in found], np.int64)


def _joined(state: DataFrame, *answers: DataFrame) -> DataFrame:
    """Each batch with its answers in order of their ranges."""
    for i, frame in enumerate(answers):
        got = frame.where("batch >= 0").groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("bucket", "values"))).alias(f"a{i}"))
        state = state.join(got, "batch")
    return state


def _values(row: dict, name: str, width: int) -> np.ndarray:
    return np.concatenate([unpacked(x["values"], np.uint64).reshape(-1, width) for x in row[name]]).astype(np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """(0, D1, D2, D3+) from counts of counts 1 to 4."""
    n1, n2, n3, n4 = (int(x) for x in n)
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        if all(0 < d < k for k, d in enumerate(found, 1)):
            return np.array([0.0, *found])
    return np.array([0.0, 0.5, 1.0, 1.5])


def log_probabilities(
    docs: DataFrame, train: Column, order: int = 3, batch_words: int = 800_000, shard_words: int = 600_000, fan: int = 256,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """A row for each row of `docs`: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    The model, of n-grams up to `order` (2 or more), learns from rows for which `train` holds, or
    is null; the others are held out. `score` is the text's log10 probability under the model;
    `base_score` that of add-one unigrams; `n_known` counts its tokens seen in training. Null and
    empty texts are an end alone. Repeated rows count, and are scored, each. Perplexity is
    10 ** (-score / n_tokens). `fan`, `batch_words` and `shard_words` bound what a task holds and
    change no result.
    """
    state = written_in_buckets(encode(docs, train, batch_words, doc_id, text), "batch", "batches")
    batches, total = state.agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    buckets = max(partitions(docs.sparkSession), -(-total // shard_words))
    found: dict[int, DataFrame] = {}
    sums: dict[int, np.ndarray] = {}
    widths = {k: 1 if k == order else 6 if k == 1 else 5 for k in range(1, order + 1)}
    for k in range(order, 0, -1):
        source = _joined(state, found[k + 1]) if k < order else state

        def send(ranges: int, k: int = k, source: DataFrame = source) -> DataFrame:
            def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for row in _rows(stream):
                    own = Batch(row, min(k + 1, order))
                    above = _values(row, "a0", widths[k + 1] + 1)[:, [0, -1]] if k < order else None
                    yield _table(list(_sent(row["batch"], own.grams[k - 1].hashes, own.columns(k, above), ranges)))

            return source.mapInArrow(run, BLOB)

        found[k] = exchange(send, batches, buckets, widths[k], fan, f"order{k}")
        sums[k] = _sums(found[k])
        if not len(sums[k]):
            sums[k] = np.zeros(widths[k] + 5, np.int64)
    cut = {k: discounts(v[:4]) for k, v in sums.items()}
    kinds, tokens, vocabulary = int(sums[1][4]), int(sums[1][9]), int(sums[1][10])
    # Mass that the discounts of the word level set free, shared by the vocabulary and one unseen word.
    n1, n2 = int(sums[1][0]), int(sums[1][1])
    spare = cut[1][1] * n1 + cut[1][2] * n2 + cut[1][3] * (vocabulary - n1 - n2)

    def score(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(stream):
            own = Batch(row, order)
            know = _values(row, "a0", widths[1] + 1)
            seen = know[:, 5]
            p = np.full(len(seen), 1.0 / (vocabulary + 1))
            if kinds:
                p = np.maximum(know[:, 0] - cut[1][np.minimum(know[:, 0], 3)], 0) / kinds + spare / kinds * p
            for k in range(2, order + 1):
                above, gram = know, own.grams[k - 1]
                know = _values(row, f"a{k - 1}", widths[k] + 1)
                c, share = know[:, 0], np.maximum(above[:, 1], 1)
                back = np.where(above[:, 1] > 0, (above[:, 2:5] @ cut[k][1:]) / share, 1.0)
                p = np.maximum(c - cut[k][np.minimum(c, 3)], 0) / share[gram.head] + back[gram.head] * p[gram.tail]
            base = np.log10((seen + 1) / (tokens + vocabulary + 1))
            word, n = own.grams[0].place, len(own.sizes)
            add = lambda values: np.bincount(own.doc, values, n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own.ids, pa.int64()), pa.array(own.held), pa.array(own.sizes),
                    pa.array(add(seen[word] > 0).astype(np.int64)), pa.array(np.full(n, tokens)),
                    pa.array(add(base[word])), pa.array(add(np.log10(p)[own.grams[-1].place])),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return _joined(state, *(found[k] for k in range(1, order + 1))).mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
