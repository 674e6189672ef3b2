"""Token ids of whole documents as ORC files, in ascending order of document id.

Documents are dealt by range of id, so each file holds one stretch of ids in order, encoded by
its own task. Ids are an integer list column, which ORC writes in run-length encoded stripes;
row indexes and a Bloom filter on `doc_id` let a reader skip files, stripes and row groups.
`local_start` counts the ids before a document in its own file; the files' totals, one number
each, give the start in the whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, pieces, small_batches
from .tokens import encoder

OPTIONS = {
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
    "orc.row.index.stride": "1000", "orc.stripe.size": str(64 << 20), "compression": "zstd",
}
SCHEMA = "part int, doc_id long, local_start long, n_tokens int, ids array<int>"


def write_tokens(
    docs: DataFrame, out: str, tokenizer: str, end_id: int, joins_space: bool = False,
    doc_id: str = "doc_id", text: str = "text", files: int | None = None,
) -> None:
    """Encode every row of `docs` and write it to `out`.

    A null text is empty: its only id is the end. Rows with a null id come first, repeated ids
    stand side by side, those with equal ids by digest of the text. No row gives no ids.
    """
    spark = docs.sparkSession

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in pieces(stream):
            blobs = encoder(tokenizer, joins_space).encode(batch.column("text").to_pylist())
            end = np.array([end_id], np.uint32).tobytes()
            sizes = np.array([len(b) // 4 + 1 for b in blobs], np.int64)
            ids = pa.array(np.frombuffer(b"".join(x for b in blobs for x in (b, end)), np.int32))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(sizes), part, np.int32)), batch.column("doc_id"), pa.array(at + ends[:-1]),
                    pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids),
                ],
                ["part", "doc_id", "local_start", "n_tokens", "ids"],
            )
            at += int(ends[-1])

    own = small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # A document id that holds very many rows is split by its texts, then by its place in the input.
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = own.repartitionByRange(files or partitions(spark), *order)
    dealt.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(encode, SCHEMA).write.options(**OPTIONS).orc(out)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files at `path`; `start` counts all ids before the document."""
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids"
    )


def with_crc32(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows as `read_tokens` returns them: the unsigned CRC-32 of a document's
    ids as little-endian unsigned 32-bit integers, taken over the ids where they lie in an Arrow batch."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy().tolist()
            flat = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
