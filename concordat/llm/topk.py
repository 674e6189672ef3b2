"""Exact top-k inner products by norm buckets.

Vectors are dealt by length, longest first, and cut into buckets of like length. A query with
a k-th score so far can only gain from a bucket where its cosine threshold

    theta / (length of the query * greatest length in the bucket)

is at most one. Above one the bucket is passed over. Where the threshold is high, the bucket's
candidates are cut down by coordinates: a unit vector within an angle a of the query is within
a of it towards every axis, which bounds each coordinate. Where it is low, only
vectors too short to reach theta are left out. What remains is verified by its product.

Queries lie in blocks of like length. Thresholds come from a first round against the longest
vectors alone. From them follows the length that a vector needs to matter to any query of a
block: pairs of a query block and a bucket without such a vector are dropped while they are two
numbers, before any matrix is joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, written

BLOCK = "block long, dim int, rows binary, ids binary, asked binary, matrix binary, longest double"
QUERIES = "q_block long, dim int, q_rows binary, q_ids binary, q_matrix binary"
FLOORS = "q_block long, floor binary, needs double"
FOUND = "query long, query_id long, vec_id long, score long"
EXACT = 2.0**53


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double; null for a null vector or a component null or not finite."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Runs of at most `size` rows (row, vec_id, asked, vector) of one dimension as one row each, in the order of the partition.

    A block is named by the number of its first row.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def block(dim: int) -> pa.RecordBatch:
            own, ids, asked, vectors = zip(*held.pop(dim))
            matrix = np.array(vectors, float).reshape(len(ids), dim)
            longest = float(np.sqrt((matrix**2).sum(1)).max()) if dim else 0.0
            blobs = [np.array(own, "<i8"), np.array(ids, "<i8"), np.array(asked, bool), matrix]
            arrays = [pa.array([own[0]]), pa.array([dim], pa.int32()), *(pa.array([x.tobytes()]) for x in blobs), pa.array([longest])]
            return pa.RecordBatch.from_arrays(arrays, ["block", "dim", "rows", "ids", "asked", "matrix", "longest"])

        for batch in stream:
            for row in zip(*(batch.column(n).to_pylist() for n in ("row", "vec_id", "asked", "vector"))):
                dim = len(row[3])
                held.setdefault(dim, []).append(row)
                if len(held[dim]) == size:
                    yield block(dim)
        for dim in list(held):
            yield block(dim)

    return rows.mapInArrow(run, BLOCK)


def _questions(stream: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The queries among a bucket's rows, in blocks of at most `size`."""
    for batch in stream:
        for row in batch.to_pylist():
            own, ids = np.frombuffer(row["rows"], "<i8"), np.frombuffer(row["ids"], "<i8")
            matrix = np.frombuffer(row["matrix"]).reshape(len(ids), row["dim"])
            asked = np.flatnonzero(np.frombuffer(row["asked"], bool))
            for at in range(0, len(asked), size):
                some = asked[at : at + size]
                arrays = [pa.array([int(own[some[0]])]), pa.array([row["dim"]], pa.int32())]
                arrays += [pa.array([x[some].tobytes()]) for x in (own, ids, matrix)]
                yield pa.RecordBatch.from_arrays(arrays, ["q_block", "dim", "q_rows", "q_ids", "q_matrix"])


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer inner products of one query with the rows of p, clipped to 64 bits."""
    if len(q) * np.abs(q).max(initial=0) * np.abs(p).max(initial=0) < EXACT:
        return (p @ q).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in p]
    return np.array([min(max(x, -(2**63)), 2**63 - 1) for x in whole], np.int64)


class Bucket:
    """Vectors of like length, longest first, with each coordinate of their unit vectors sorted."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, matrix: np.ndarray):
        self.length = np.sqrt((matrix**2).sum(1))
        order = np.argsort(-self.length, kind="stable")
        self.rows, self.ids, self.matrix, self.length = rows[order], ids[order], matrix[order], self.length[order]
        unit = self.matrix / np.maximum(self.length, 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(unit, self.order, 0)

    def candidates(self, q: np.ndarray, size: float, theta: float, focus: int = 4) -> np.ndarray | slice | None:
        """Rows that may score theta or more against q of length `size`; None for no row."""
        if theta <= 0 or not size or not len(self.ids):
            return slice(None)
        reach = size * self.length
        t = theta / max(reach[0], 1e-300) * (1 - 1e-9)
        if t > 1:
            return None
        last = int(np.searchsorted(-reach, -theta * (1 - 1e-9), "right"))  # shorter ones cannot reach theta
        if t < 0.5:
            return slice(0, last)
        unit = q / size
        votes = np.zeros(len(self.ids), np.int8)
        strongest = np.argsort(-np.abs(unit), kind="stable")[:focus]
        wide = math.acos(min(1.0, max(-1.0, t)))  # the widest angle between q and a vector of cosine t or more
        for f in strongest:
            turn = math.acos(min(1.0, max(-1.0, unit[f])))
            low = np.searchsorted(self.sorted[:, f], math.cos(min(math.pi, turn + wide)) - 1e-9)
            high = np.searchsorted(self.sorted[:, f], math.cos(max(0.0, turn - wide)) + 1e-9, "right")
            votes[self.order[low:high, f]] += 1
        found = np.flatnonzero(votes == len(strongest))
        return found[found < last]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _bucket(row: dict) -> Bucket:
    rows, ids = np.frombuffer(row["rows"], "<i8"), np.frombuffer(row["ids"], "<i8")
    return Bucket(rows, ids, np.frombuffer(row["matrix"]).reshape(len(ids), row["dim"]))


def search(bucket: Bucket, rows: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple]:
    """(place, ids, scores): the k best rows of the bucket, but the query's own, that reach its floor, ties to the smaller id."""
    for place, (own, q, theta) in enumerate(zip(rows, queries, floor)):
        found = bucket.candidates(q, float(np.sqrt(q @ q)), float(theta))
        if found is None:
            continue
        scores = _products(q, bucket.matrix[found])
        keep = (bucket.rows[found] != own) & (scores >= theta)
        ids, scores = bucket.ids[found][keep], scores[keep]
        best = _best(ids, scores, k)
        yield place, ids[best], scores[best]


def _meet(stream: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Search each bucket with each query block that it was joined with."""
    last, bucket = None, None
    for batch in stream:
        for row in batch.to_pylist():
            if row["block"] != last:
                last, bucket = row["block"], _bucket(row)
            asked, ids = np.frombuffer(row["q_rows"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
            queries = np.frombuffer(row["q_matrix"]).reshape(len(asked), row["dim"])
            found = list(search(bucket, asked, queries, np.frombuffer(row["floor"]), k))
            if found:
                place = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
                arrays = [asked[place], ids[place], np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["query", "query_id", "vec_id", "score"])


def _floors(stream: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k-th best score of each query of a block against one bucket, -inf where it has fewer; and the least length
    of a vector that reaches the floor of any of the queries."""
    for batch in stream:
        for row in batch.to_pylist():
            asked = np.frombuffer(row["q_rows"], "<i8")
            queries = np.frombuffer(row["q_matrix"]).reshape(len(asked), row["dim"])
            none = np.full(len(asked), -np.inf)
            floor = none.copy()
            for place, _, scores in search(_bucket(row), asked, queries, none, k):
                if len(scores) == k:
                    floor[place] = scores[-1]
            size = np.sqrt((queries**2).sum(1))
            needs = np.divide(floor, size, out=none, where=size > 0).min()
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["q_block"]]), pa.array([floor.tobytes()]), pa.array([needs])], ["q_block", "floor", "needs"]
            )


def top_k(
    rows: DataFrame, asked: Column, k: int = 5, bucket_rows: int = 8192, query_rows: int = 1024,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest inner products of each row that is `asked` with all rows but itself.

    Scores are exact integers of the quantised vectors; ties go to the smaller id. Vectors that
    are null or hold a null or a component not finite take no part, nor do rows with a null id.
    Only vectors of one dimension meet; vectors may be of any length. Repeated rows, and rows that
    share an id, are each a query and a candidate of its own: a query meets its copies. A null `asked`
    asks nothing. A score beyond 64 bits is given as the nearest 64-bit number. An empty table gives no row.
    """
    spark = rows.sparkSession
    whole = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.coalesce(asked, F.lit(False)).alias("asked"), quantised(F.col(vector)).alias("vector")
    ).where("vec_id is not null and vector is not null")
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    dealt = whole.withColumn("square", square).repartitionByRange(
        partitions(spark), F.size("vector"), F.desc("square"), "vec_id", F.monotonically_increasing_id()
    )
    dealt = dealt.sortWithinPartitions(F.size("vector"), F.desc("square"), "vec_id")
    dealt = dealt.select(F.monotonically_increasing_id().alias("row"), "vec_id", "asked", "vector")
    buckets = written(_blocks(dealt, bucket_rows), "buckets")
    queries = buckets.mapInArrow(lambda stream: _questions(stream, query_rows), QUERIES)
    # Query blocks are spread over `share`, so that no dimension is one task.
    share = F.pmod(F.xxhash64("q_block"), F.lit(partitions(spark))).cast("int")
    queries = written(queries.withColumn("share", share), "queries")

    sizes = buckets.select("block", "dim", "longest")
    shares = queries.select("dim", "share").distinct()
    longest = sizes.groupBy("dim").agg(F.max_by("block", F.struct("longest", "block")).alias("block"))
    heads = shares.join(longest, "dim").join(buckets.drop("dim", "longest", "asked"), "block")
    first = queries.join(heads, ["dim", "share"])
    floors = written(first.mapInArrow(lambda stream: _floors(stream, k), FLOORS), "floors")

    wants = queries.select("q_block", "dim", "share").join(floors.select("q_block", "needs"), "q_block")
    pairs = wants.join(shares.join(sizes, "dim"), ["dim", "share"]).where(F.col("longest") >= F.col("needs") * (1 - 1e-9))
    met = (
        pairs.select("q_block", "block")
        .join(queries.drop("dim", "share").join(floors.drop("needs"), "q_block"), "q_block")
        .join(buckets.drop("longest", "asked"), "block")
    )
    found = met.mapInArrow(lambda stream: _meet(stream, k), FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
