"""Mixing sources to target weights by fixed-length blocks of words.

The documents of a source, in pseudorandom order, form one run of words that is cut into
blocks. Output shards have a fixed number of slots; the count of slots that each source gets
in a shard is a multinomial draw from what is left of the sources' quotas, made by halving the
range of shards, so any task can draw any shard on its own and the quotas are met exactly.
A source's slots are numbered through all shards; pass p over its blocks maps slot number i to
block perm(i), a pseudorandom permutation of the block numbers, and slots and blocks are joined
by source and block number. No block is taken more often than the source's passes, which are
two at most, so no document is either.

Positions in a source come from sums over a fixed tree of ranges of the documents' hashes, so a
source of any size is summed in parallel. Sources are a configuration: one row for each passes
through the driver, nothing else does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import WORD, free_name, partitions, small_batches, word_count, written

# Fixed values of the mix: weights by rank of the source, total against all sizes, greatest share of a source.
WEIGHTS, TOTAL, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
PASSES = 2


def targets(sizes: dict, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> dict:
    """The target of each source (by code point, null last), none above `most` times its size; excess goes to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    found: dict = {}
    left = total * sum(sizes.values())
    while open_ := [s for s in names if s not in found]:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * share > most * sizes[s]]
        if not full:
            return found | {s: weight[s] * share for s in open_}
        for s in full:
            found[s] = most * sizes[s]
            left -= found[s]
    return found


def split_counts(counts: np.ndarray, room: int, key: list[int]) -> np.ndarray:
    """A multinomial draw of `room` slots from `counts`, none above its count, the same for the same key."""
    rng = np.random.default_rng(key)
    drawn = np.zeros_like(counts)
    while (missing := room - int(drawn.sum())) > 0:
        free = counts - drawn
        more = np.minimum(rng.multinomial(missing, free / free.sum()), free)
        drawn = drawn + more
    return drawn


def draw_shards(quotas: np.ndarray, slots: int, low: int, high: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first slot number, slot count) by source, for the shards in [low, high)."""
    total = int(quotas.sum())
    shards = -(-total // slots)

    def walk(a: int, b: int, counts: np.ndarray, first: np.ndarray) -> Iterator:
        if b <= low or a >= high:
            return
        if b - a == 1:
            yield a, first, counts
            return
        mid = (a + b) // 2
        left = split_counts(counts, (mid - a) * slots, [seed, a, b])
        yield from walk(a, mid, left, first)
        yield from walk(mid, b, counts - left, first + left)

    if total:
        yield from walk(0, shards, quotas.astype(np.int64), np.zeros(len(quotas), np.int64))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of [0, n) at `index`: four Feistel rounds, walked until they land below n."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask = np.uint64((1 << half) - 1)

    def rounds(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            mixed = (right + np.uint64((key * 4 + r + 1) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = rounds(index.astype(np.uint64))
    while (over := out >= n).any():
        out[over] = rounds(out[over])
    return out.astype(np.int64)


def _positions(rows: DataFrame) -> DataFrame:
    """`rows` (s, h, uid, size) with `at`: the sizes before it among rows of the same s, ordered by h and uid."""
    cut = rows.withColumn("b1", F.shiftrightunsigned("h", 52)).withColumn("b2", F.shiftrightunsigned("h", 40).bitwiseAND(F.lit(4095)))
    second = cut.groupBy("s", "b1", "b2").agg(F.sum("size").alias("size"))
    first = second.groupBy("s", "b1").agg(F.sum("size").alias("size"))
    back = (Window.unboundedPreceding, -1)

    def before(*by: str):
        return lambda *order: F.coalesce(F.sum("size").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(*back)), F.lit(0))

    first = first.select("s", "b1", before("s")("b1").alias("at1"))
    second = second.select("s", "b1", "b2", before("s", "b1")("b2").alias("at2"))
    own = cut.withColumn("at3", before("s", "b1", "b2")("h", "uid"))
    base = second.join(first, ["s", "b1"]).select("s", "b1", "b2", (F.col("at1") + F.col("at2")).alias("base"))
    placed = own.join(base, ["s", "b1", "b2"])
    return placed.withColumn("at", F.col("base") + F.col("at3")).drop("b1", "b2", "at3", "base", "h")


class Mix:
    """A mix of `docs`: who takes part, with targets (`documents`), and what is taken (`pieces`).

    documents: uid, doc_id, size, source_size, target; one row for each row of `docs`, repeated
    rows and rows without words included. pieces: uid, shard, slot, pass_, start, n_words; `start`
    counts words of the document. Null ids and sources are ids and a source like others.
    """

    def __init__(self, docs: DataFrame, seed: int = 11, block_words: int = 64, shard_slots: int = 4096, doc_id: str = "doc_id", text: str = "text", source: str = "source", uid: str | None = None):
        spark = docs.sparkSession
        own = docs.select(
            (F.col(uid) if uid else F.monotonically_increasing_id()).alias("uid"), F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("h"),
        )
        rows = written(own, "sizes")
        sizes = {r["source"]: int(r["size"]) for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()}
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        goal = targets(sizes)
        blocks = np.array([-(-sizes[s] // block_words) for s in names], np.int64)
        share = [goal[s] / sizes[s] if sizes[s] else 0.0 for s in names]
        quotas = np.minimum(np.round(np.array(share) * blocks).astype(np.int64), PASSES * blocks)
        # As an Arrow table: rows of a list would go through Python workers of another kind, which stay beside the others.
        told = [range(len(names)), names, [sizes[s] for s in names], [float(goal[s]) for s in names]]
        kind = f"s int, source {rows.schema['source'].dataType.simpleString()}, source_size long, target double"
        kinds = [pa.int32(), to_arrow_type(rows.schema["source"].dataType), pa.int64(), pa.float64()]
        table = spark.createDataFrame(pa.table([pa.array(x, t) for x, t in zip(told, kinds)], ["s", "source", "source_size", "target"]), kind)
        known = rows.withColumnRenamed("source", "own").join(F.broadcast(table), F.col("own").eqNullSafe(F.col("source")))
        self.documents = known.select("uid", "doc_id", "size", "source_size", "target")

        placed = _positions(known.where("size > 0").select("s", "h", "uid", "size"))
        spans = placed.withColumn(
            "block", F.explode(F.sequence(F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}")))
        ).select(
            "s", "block", "uid", F.greatest(F.lit(0), F.col("block") * block_words - F.col("at")).alias("start"),
            F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("at")).alias("stop"),
        )
        shards = int(-(-quotas.sum() // shard_slots))

        def draw(stream: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in stream:
                for shard in part["id"]:
                    for _, first, counts in draw_shards(quotas, shard_slots, int(shard), int(shard) + 1, seed):
                        s = np.repeat(np.arange(len(counts)), counts)
                        within = np.arange(len(s)) - np.repeat(np.cumsum(counts) - counts, counts)
                        number = first[s] + within
                        turn, index = number // np.maximum(blocks[s], 1), number % np.maximum(blocks[s], 1)
                        block = np.zeros(len(s), np.int64)
                        for i, p in {(int(i), int(p)) for i, p in zip(s, turn)}:
                            own = (s == i) & (turn == p)
                            block[own] = permuted(index[own], int(blocks[i]), (seed * 1_000_003 + i) * PASSES + p)
                        slot = np.random.default_rng([seed, int(shard)]).permutation(len(s))
                        yield pd.DataFrame({"shard": shard, "slot": slot, "s": s, "pass_": turn, "block": block})

        slots = spark.range(0, shards, 1, max(1, min(shards, partitions(spark)))).mapInPandas(
            draw, "shard long, slot long, s int, pass_ int, block long"
        )
        # The planner takes the slots for as small as the range they come from; they are as many as the blocks.
        self.pieces = slots.hint("merge").join(spans, ["s", "block"]).select(
            "uid", "shard", "slot", "pass_", "start", (F.col("stop") - F.col("start")).alias("n_words")
        )

    def taken(self) -> DataFrame:
        """`documents` with `taken`: the words that the mix takes of each, repeats counted."""
        words = self.pieces.groupBy("uid").agg(F.sum("n_words").alias("taken"))
        return self.documents.join(words, "uid", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The runs of words of each text that spans (pass_, start, n_words) cover, pass by pass, as they stand in the text."""
    import re

    word, out = re.compile(WORD), []
    for t, own in zip(text, spans):
        places = [m.span() for m in word.finditer(t or "")]
        runs: list[list[int]] = []
        for turn, start, n in sorted((x["pass_"], x["start"], x["n_words"]) for x in own):
            if runs and runs[-1][0] == turn and runs[-1][2] == start:
                runs[-1][2] = start + n
            else:
                runs.append([turn, start, start + n])
        out.append([t if a == 0 and b == len(places) else t[places[a][0] : places[b - 1][1]] for _, a, b in runs])
    return pd.Series(out)


# Marked so, or the planner copies it into a filter before the explode, and each task runs it twice, in two workers at once.
_cut = _cut.asNondeterministic()


def mixed_rows(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", **options) -> DataFrame:
    """The mix as rows of `docs`: one for each run of words taken of a document in one pass, its text the run as it
    stands in the document, its `n_chars` the run's length. Whole documents taken stay whole. Columns stay as they are."""
    uid, runs = free_name(docs, "row_number"), free_name(docs, "runs")
    held = written(small_batches(docs).withColumn(uid, F.monotonically_increasing_id()), "mixed")
    spans = Mix(held, uid=uid, text=text, **options).pieces.groupBy("uid").agg(F.collect_list(F.struct("pass_", "start", "n_words")).alias(runs))
    cut = held.join(spans.withColumnRenamed("uid", uid), uid).withColumn(runs, _cut(F.col(text), F.col(runs)))
    rows = cut.withColumn(runs, F.explode(runs)).withColumn(text, F.col(runs))
    if n_chars and n_chars in docs.columns:
        rows = rows.withColumn(n_chars, F.length(runs).cast(docs.schema[n_chars].dataType))
    return rows.select(*docs.columns)
