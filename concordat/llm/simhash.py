"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming distances, components.

`near_groups` links 64-bit fingerprints at a small Hamming distance d, exactly. The bits are
split into blocks; two fingerprints at d or less agree on all but d blocks, so they share the
key of one choice of the others. Fingerprints are joined on keys and pairs verified. A key that
very many fingerprints share (a large group of near copies) forms no pairs: its members meet
at the fingerprints one bit away from them, of which two members share one just when they are
at two or less, and each such meeting place, which holds 65 at most, links its members to the
smallest. That costs 65 rows a member, whatever the group's size, and loses no component.

`similar_rows` keeps one of each group of near copies, by the Jaccard similarity of their sets of
word shingles. No distance of fingerprints tells a similarity of 0.8 with bounded work, so fingerprints propose links
here and sets decide on them; what fingerprints miss is found exactly, by a prefix filter.
Shingles have one order for all texts: those of few texts first, common ones last. Two sets of that
similarity share a shingle among the first ninth of the smaller and the first fifth of the larger, so texts meet in those
only. A passage that very many texts share stands last in all of them, and brings none of them together unless they are nearly made of it.

Equal fingerprints are one node from the start, so copies never form pairs.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, partitions, pieces, small_batches, written
from .components import connected

CHUNK = 1 << 14


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `size` words, A-Z lower-cased and joined by spaces; of all words where there are fewer."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    last = ends[size - 1 :].tolist() if len(words) >= size else [len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, last)], np.uint64)


def _lanes(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """`lanes` 64-bit hashes of each hash; the first is the hash itself."""
    salt = np.arange(lanes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = hashes[:, None] ^ salt[None, :]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed[:, 1:] ^= mixed[:, 1:] >> np.uint64(shift)
        mixed[:, 1:] *= np.uint64(factor)
    mixed[:, 1:] ^= mixed[:, 1:] >> np.uint64(31)
    return mixed


def majority_bits(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """For each bit, highest first, whether over half of the hashes have it; none for no hash."""
    votes = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = _lanes(hashes[at : at + CHUNK], lanes)
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(len(part), -1), axis=1)
        for low in range(0, len(bits), 255):
            votes += bits[low : low + 255].sum(0, dtype=np.uint8)
    return 2 * votes > len(hashes)


def fingerprint(shingle: int):
    """A function of a text column: its 64-bit fingerprint as a signed long."""

    @F.pandas_udf("long")
    def print_(text: pd.Series) -> pd.Series:
        return pd.Series(
            [int.from_bytes(np.packbits(majority_bits(shingle_hashes(t, shingle))).tobytes(), "big", signed=True) for t in text],
            dtype="int64",
        )

    return print_


def hex_digits(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def _masks(blocks: int, shared: int) -> list[int]:
    """The signed 64-bit masks of every choice of `shared` out of `blocks` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    whole = [sum(choice) for choice in itertools.combinations(parts, shared)]
    return [m - (1 << 64) if m >> 63 else m for m in whole]


def print_links(prints: DataFrame, max_distance: int = 2, blocks: int = 4, group_rows: int = 32) -> DataFrame:
    """(a, b): links between the distinct fingerprints `f` of `prints` that connect all at `max_distance` or less.

    Every link is at `max_distance` or less. Keys shared by `group_rows` or fewer give all
    pairs; those shared by more give links of the same components (`max_distance` 1 or 2).
    """
    if max_distance not in (1, 2):
        raise ValueError("max_distance is 1 or 2")
    keys = [F.struct(F.lit(i).alias("c"), F.col("f").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(_masks(blocks, blocks - max_distance))]
    keyed = prints.select("f", F.inline(F.array(*keys)))
    sizes = keyed.groupBy("c", "v").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keyed.join(sizes, ["c", "v"]), "blocks")
    few = shared.where(F.col("n") <= group_rows).select("c", "v", "f")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    pairs = (
        few.withColumnRenamed("f", "a").join(few.withColumnRenamed("f", "b"), ["c", "v"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    )
    flips = [F.col("f")] + [F.col("f").bitwiseXOR(F.lit((1 << i) - (1 << 64 if i == 63 else 0))) for i in range(64)]
    many = shared.where(F.col("n") > group_rows).select("f").distinct()
    met = many.select("f", F.explode(F.array(*flips)).alias("place")).groupBy("place").agg(F.array_sort(F.collect_set("f")).alias("s"))
    if max_distance == 1:  # two members of a place may be at two; the place itself, where it is one, is at one from each
        met = met.where(F.array_contains("s", F.col("place"))).select("place", F.explode("s").alias("b")).where("place <> b")
        met = met.select(F.least("place", "b").alias("a"), F.greatest("place", "b").alias("b"))
    else:
        met = met.where("size(s) > 1").select(F.element_at("s", 1).alias("a"), F.explode(F.slice("s", 2, 65)).alias("b"))
    return pairs.unionAll(met.where(near)).distinct()


def near_groups(
    docs: DataFrame, shingle: int = 3, max_distance: int = 2, blocks: int = 4, group_rows: int = 32,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`, repeated rows included.

    The component is the smallest id that links reach. Texts without words, null ones too, have
    the fingerprint zero, which links like any other. A null id is in no component's name; a
    component of null ids only has a null name.
    """
    prints = written(small_batches(docs).select(F.col(doc_id).alias("doc_id"), fingerprint(shingle)(F.col(text)).alias("f")), "prints")
    nodes = prints.groupBy("f").agg(F.min("doc_id").alias("least"))
    groups = connected(print_links(nodes.select("f"), max_distance, blocks, group_rows), "a", "b")
    placed = nodes.join(groups.withColumnRenamed("node", "f"), "f", "left")
    placed = placed.withColumn("component", F.coalesce("component", "f"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.select("f", "component").join(names, "component").select("f", "component_id")
    return prints.join(named, "f").select("doc_id", hex_digits(F.col("f")).alias("fingerprint"), "component_id")


# Distinct words a worker keeps the hashes of.
KEPT = 100_000
# Buckets of shingles that can be marked as common, as a power of two: a bitmap of 4 MB, whatever the corpus.
MARKS = 25
# Bits of a shingle's hash that are shuffled to count it; counts only order shingles.
COUNTED = 40
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word, 42)
        return found


_KNOWN = _Words()


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """One by one, the set of each text's runs of `size` words, A-Z lower-cased, as ascending 64-bit hashes; of all its words where there are fewer.

    A run's hash is a polynomial in its words' hashes, so runs are never built.
    """
    global _KNOWN
    for text in texts:
        if len(_KNOWN) > KEPT:
            _KNOWN = _Words()
        said = (text or "").encode("utf-8", "replace").lower().split()
        run = min(size, len(said))
        if not run:
            yield np.empty(0, np.uint64)
            continue
        words = np.fromiter(map(_KNOWN.__getitem__, said), np.uint64, len(said))
        last = len(words) - run + 1
        mixed = words[:last].copy()
        for k in range(1, run):
            mixed = _stirred(mixed * FACTOR + words[k : last + k])
        yield np.unique(_stirred(mixed + np.uint64(run)))


def _outline(shingle: int):
    """What is kept of each text: a digest and the size of its set, and its fingerprint."""

    @F.pandas_udf("node binary, size int, f long")
    def outline(text: pd.Series) -> pd.DataFrame:
        rows = []
        for own in shingle_sets(text.tolist(), shingle):
            f = int.from_bytes(np.packbits(majority_bits(own)).tobytes(), "big", signed=True)
            rows.append((hashlib.md5(own.tobytes()).digest(), len(own), f))
        return pd.DataFrame(rows, columns=["node", "size", "f"])

    return outline


def _alike(shingle: int, similarity: float):
    """Of batches (a, b, a_text, b_text) the pairs whose sets have the similarity."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of a batch only a few MB of texts are taken apart at a time: sets are larger than texts.
        for batch in pieces(stream, 2 << 20):
            # Pairs come sorted by one end, so many share a text: each is taken apart once.
            left, right = (batch.column(f"{n}_text").to_pylist() for n in ("a", "b"))
            numbers: dict[str | None, int] = {}
            ends = [(numbers.setdefault(x, len(numbers)), numbers.setdefault(y, len(numbers))) for x, y in zip(left, right)]
            sets = list(shingle_sets(list(numbers), shingle))
            keep = []
            for a, b in ends:
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                keep.append(both * (1 + similarity) >= (len(sets[a]) + len(sets[b])) * similarity - 1e-6)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def common_marks(texts: DataFrame, shingle: int, least: int) -> tuple[bytes, int]:
    """A bitmap of the buckets that a shingle of `least` or more texts falls in, and the `least` it was made with.

    Shingles are counted over all of `texts` (column text). `least` doubles until no more than an eighth of the buckets
    can be marked, so the bitmap, which is all that comes to the driver, has one size for any corpus. It only orders
    shingles: any bitmap gives the same result.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(stream, 4 << 20):
            sets = list(shingle_sets(batch.column(0).to_pylist(), shingle))
            found, n = np.unique(np.concatenate(sets) >> np.uint64(64 - COUNTED), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int32))], ["h", "n"])

    # Nearly all shingles differ, so adding them up before the shuffle would fill memory for nothing. The structure keeps
    # the sums from being hashed: they are sorted, and added up as they pass.
    met = texts.select("text").mapInArrow(run, "h long, n int").repartition(partitions(texts.sparkSession), "h")
    summed = met.groupBy("h").agg(F.sum("n").alias("n"), F.max(F.struct("n")).alias("most"))
    often = written(summed.where((F.col("n") >= least) & F.col("most").isNotNull()).drop("most"), "common")
    power = F.floor(F.log2(F.col("n") / least)).cast("int")
    sizes = dict(often.groupBy(power.alias("p")).agg(F.count("*").alias("n")).collect())
    step = 0
    while sum(n for p, n in sizes.items() if p >= step) > 1 << (MARKS - 3):
        step += 1
    bucket = F.shiftright("h", COUNTED - MARKS)
    word = often.where(F.col("n") >= least << step).groupBy(F.shiftright(bucket, 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftright(h, {COUNTED - MARKS}) & 63 as int))")).alias("bits")
    )
    found = word.toArrow()
    marks = np.zeros(1 << (MARKS - 6), np.int64)
    marks[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return marks.tobytes(), least << step


def _first_shingles(shingle: int, similarity: float, marks: bytes):
    """For each text how many rare shingles it has, and its first shingles in the common order: (h, place)."""
    words = np.frombuffer(marks, np.uint64)

    @F.pandas_udf("rare int, first array<long>")
    def first(text: pd.Series) -> pd.DataFrame:
        rows = []
        for own in shingle_sets(text.tolist(), shingle):
            bucket = own >> np.uint64(64 - MARKS)
            common = (words[(bucket >> np.uint64(6)).astype(np.int64)] >> (bucket & np.uint64(63)) & np.uint64(1)).astype(bool)
            ordered = np.concatenate([own[~common], own[common]])
            rows.append((int(len(own) - common.sum()), ordered[: len(own) - _share(len(own), similarity) + 1].view(np.int64)))
        return pd.DataFrame(rows, columns=["rare", "first"])

    return first


def _share(n: int, ratio: float) -> int:
    """The least whole number that is `ratio` of `n` or more, safe from rounding."""
    return int(np.ceil(n * ratio - 1e-6))


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) of numbers in `texts` whose sets have the similarity. Texts are shuffled, which are smaller than sets."""
    left, right = (texts.select(F.col("uid").alias(n), F.col("text").alias(f"{n}_text")) for n in ("a", "b"))
    met = small_batches(pairs.join(left, "a").join(right, "b"))
    return met.select("a", "b", "a_text", "b_text").mapInArrow(_alike(shingle, similarity), "a long, b long")


def similar_rows(
    docs: DataFrame, similarity: float = 0.8, shingle: int = 5, common: int = 8, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of `docs` without near copies: of each group of texts linked by the similarity, one row.

    The kept row is the one of the smallest id, a null id last. Texts are linked if the Jaccard similarity of their shingle sets is
    `similarity` or more; groups are those of all such pairs, none is missed. Texts of one set, or without words, null ones too, are equal.
    Repeated rows are copies. Very long texts are worked on whole. Columns stay as they are; an empty table stays empty.

    Links are sought in three steps, each on what is not yet linked. Fingerprints at two bits or less propose pairs; then each
    text is compared with one text, that most of its first shingles lead to: of all texts with a shingle, the one with the fewest rare
    shingles, which for copies of one original is the original or the copy nearest to it. Last, texts
    outside the group of their list's leader meet all others of the list that sizes and places leave room for.
    So a group of copies gives pairs in proportion to its size. `common`: texts from which a shingle counts as common, which only orders shingles.
    """
    uid, mark = free_name(docs, "row_number"), free_name(docs, "outline")
    held = written(small_batches(docs).withColumn(uid, F.monotonically_increasing_id()).withColumn(mark, _outline(shingle)(F.col(text))), "held")
    rows = held.select(F.col(uid).alias("uid"), F.col(doc_id).alias("id"), F.col(f"{mark}.node").alias("node"))
    nodes = written(held.select(F.col(uid).alias("uid"), f"{mark}.*").groupBy("node").agg(F.min(F.struct("uid", "size", "f")).alias("x")).select("node", "x.*"), "nodes")
    texts = held.join(nodes.select(F.col("uid").alias(uid)), uid, "left_semi").select(F.col(uid).alias("uid"), F.col(text).alias("text"))
    texts = written(texts, "texts")

    marks, _ = common_marks(texts, shingle, common)
    told = small_batches(texts).select("uid", _first_shingles(shingle, similarity, marks)("text").alias("t"))
    sized = told.join(nodes.select("uid", "size"), "uid").where("size > 0")
    posted = written(sized.select("uid", "size", "t.rare", F.posexplode("t.first").alias("place", "h")), "posted")
    leader = F.min(F.struct("rare", "uid")).alias("leader")
    lists = posted.groupBy("h").agg(F.count("*").alias("n"), leader).where("n > 1").select("h", F.col("leader.uid").alias("leader"))
    shared = written(posted.join(lists, "h").select("h", "uid", "size", "place", "leader"), "shared")

    most = F.max(F.struct("n", "leader")).alias("most")
    led = shared.where("uid != leader").groupBy("uid", "leader").agg(F.count("*").alias("n")).groupBy("uid").agg(most)
    led = led.select(F.least("uid", "most.leader").alias("a"), F.greatest("uid", "most.leader").alias("b"))
    prints = written(nodes.groupBy("f").agg(F.min("uid").alias("head")), "prints")
    same = nodes.join(prints, "f").where("uid != head").select(F.col("head").alias("a"), F.col("uid").alias("b"))
    near = print_links(prints.select("f")).groupBy("b").agg(F.min("a").alias("a"))  # each to its smallest neighbour
    near = near.join(prints.withColumnRenamed("f", "a"), "a").select("b", F.col("head").alias("x"))
    near = near.join(prints.withColumnRenamed("f", "b"), "b").select(F.least("x", "head").alias("a"), F.greatest("x", "head").alias("b"))
    proposed = written(led.unionAll(same).unionAll(near).distinct(), "proposed")
    links = written(_verified(proposed, texts, shingle, similarity), "links")
    groups = written(connected(links, "a", "b"), "groups")

    def grouped(frame: DataFrame, key: str, name: str) -> DataFrame:
        own = groups.select(F.col("node").alias(key), F.col("component").alias(name))
        return frame.join(own, key, "left").withColumn(name, F.coalesce(name, key))

    placed = grouped(grouped(shared, "uid", "own"), "leader", "main")
    open_ = placed.groupBy("h").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low < high").select("h")
    placed = written(placed.join(open_, "h", "left_semi"), "open")
    least = 2 * similarity / (1 + similarity)
    small = placed.where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * least - 1e-6))
    small = small.select("h", *[F.col(c).alias(f"small_{c}") for c in ("uid", "size", "place", "own")], "main")
    large = placed.select("h", "uid", "size", "place", "own", (F.col("own") == F.col("main")).alias("inside"))
    overlap = F.ceil((F.col("size") + F.col("small_size")) * (similarity / (1 + similarity)) - 1e-6)
    room = F.least(F.col("size") - F.col("place"), F.col("small_size") - F.col("small_place")) >= overlap
    larger = (F.col("size") > F.col("small_size")) | ((F.col("size") == F.col("small_size")) & (F.col("uid") > F.col("small_uid")))
    fits = (F.col("own") != F.col("small_own")) & larger & room
    # One of the two is outside the leader's group: either the smaller, or the larger alone.
    outside, inside = small.where("small_own != main"), small.where("small_own = main")
    met = outside.join(large, "h").where(fits).select("small_uid", "uid").unionAll(
        inside.join(large.where("not inside"), "h").where(fits).select("small_uid", "uid")
    )
    met = written(met.select(F.least("small_uid", "uid").alias("a"), F.greatest("small_uid", "uid").alias("b")).distinct(), "met")
    links = links.unionAll(_verified(met, texts, shingle, similarity))

    groups = connected(links, "a", "b").withColumnRenamed("node", "uid")
    named = nodes.select("node", "uid").join(groups, "uid", "left").select("node", F.coalesce("component", "uid").alias("component"))
    stays = rows.join(named, "node").groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "uid")).alias("kept"))
    return held.join(stays.select(F.col("kept.uid").alias(uid)), uid, "left_semi").drop(uid, mark)
