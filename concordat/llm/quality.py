"""Quality rules: isolation forests over rule statistics, with thresholds from labelled rows.

A forest is a set of trees, each grown on a small random subset of labelled documents by random
splits of random statistics. A document that few splits set apart is an anomaly. There is a
forest for each rule (symbols, repetition, shape), as what is rare need not be poor: a forest
knows no good or bad, so its threshold is read off the labelled rows. Of the scores at which no
more than a share `spare` of the good ones would be rejected, and more poor than good ones, it
is the one that best tells the labels apart; a rule without such a score rejects nothing.

The statistics of a document are worked out in its own row, from its whole text; no text is
shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, small_batches

# The characters that count as symbols, and the limits of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
SCHEMA = T.StructType([T.StructField(name, T.LongType()) for name in BASE])


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    twice = times[window] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The base statistics of one text; all zero for a null."""
    if not text:
        return (0,) * len(BASE)
    words = text.encode().split()
    lines = [line for line in text.encode().split(b"\n") if line.split()]
    chars = sum(len(w) if w.isascii() else len(w.decode()) for w in words)
    return (
        len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), _repeated(words), len(lines),
    )


@F.pandas_udf(SCHEMA)
def rule_statistics(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in text], columns=BASE)


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (stats["n_repeat_words"] * 100 > stats["n_words"] * MAX_REPEAT_PERCENT)


RULES = ("symbols", "repetition", "shape")


def features(stats: pd.DataFrame) -> list[np.ndarray]:
    """What the forest of each rule splits: shares, which a document's size does not sway, and the log size."""
    words = np.maximum(stats["n_words"].to_numpy(float), 1)
    lines = np.maximum(stats["n_lines"].to_numpy(float), 1)
    symbols = stats["n_symbols"].to_numpy(float)
    return [
        np.column_stack([symbols / words, symbols / np.maximum(stats["word_chars"], 1)]),
        np.column_stack([stats["n_dup_lines"] / lines, stats["n_repeat_words"] / words]),
        np.column_stack([np.log1p(stats["n_words"].to_numpy(float)), stats["word_chars"] / words]),
    ]


def _expected(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays over (tree, node): the children of node i are 2i+1 and 2i+2."""

    feature: np.ndarray
    cut: np.ndarray
    length: np.ndarray
    depth: int
    subset: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the higher, the more anomalous. 0.5 from a forest without rows."""
        if not self.feature.size:
            return np.full(len(x), 0.5)
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, length in zip(self.feature, self.cut, self.length):
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                split = feature[at]
                at = np.where(split < 0, at, 2 * at + 1 + (x[rows, split] >= cut[at]))
            total += length[at]
        return 2.0 ** (-total / len(self.feature) / max(float(_expected(self.subset)), 1e-9))


def grow(rows: np.ndarray, trees: int = 200, subset: int = 256, seed: int = 7) -> Forest:
    """An isolation forest on `rows` (a bounded sample)."""
    rng = np.random.default_rng(seed)
    size = min(subset, len(rows))
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    nodes = 2 ** (depth + 1) - 1
    if size < 2:
        return Forest(np.empty((0, nodes), int), np.empty((0, nodes)), np.empty((0, nodes)), depth, 2)
    feature, cut, length = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for tree in range(trees):
        held = {0: rows[rng.choice(len(rows), size, replace=False)]}
        for node in range(nodes):
            if (own := held.pop(node, None)) is None:
                continue
            level = (node + 1).bit_length() - 1
            low, high = (own.min(0), own.max(0)) if len(own) else (np.zeros(1), np.zeros(1))
            wide = np.flatnonzero(high > low)
            if level == depth or len(own) < 2 or not len(wide):
                length[tree, node] = level + _expected(len(own))
                continue
            f = rng.choice(wide)
            feature[tree, node], cut[tree, node] = f, rng.uniform(low[f], high[f])
            right = own[:, f] >= cut[tree, node]
            held[2 * node + 1], held[2 * node + 2] = own[~right], own[right]
    return Forest(feature, cut, length, depth, size)


@dataclass
class QualityModel:
    forests: list[Forest]
    thresholds: list[float]  # a score above its rule's rejects

    def anomaly(self):
        """A function of the statistics: the score of each rule."""
        forests = self.forests

        @F.pandas_udf("array<double>")
        def scores(stats: pd.DataFrame) -> pd.Series:
            return pd.Series(list(np.column_stack([f.score(x) for f, x in zip(forests, features(stats))])))

        return scores

    def verdicts(self):
        """A function of a text column: whether base rules and model keep the text."""
        forests, thresholds = self.forests, np.array(self.thresholds)

        @F.pandas_udf("boolean")
        def kept(text: pd.Series) -> pd.Series:
            stats = pd.DataFrame([measure(t) for t in text], columns=BASE)
            scores = np.column_stack([f.score(x) for f, x in zip(forests, features(stats))])
            failed = (stats["n_words"] < MIN_WORDS) | (stats["n_repeat_words"] * 100 > stats["n_words"] * MAX_REPEAT_PERCENT)
            return ~failed & (scores <= thresholds).all(axis=1)

        return kept

    def kept(self, stats: Column, scores: Column) -> Column:
        kept = ~base_failed(stats)
        for i, threshold in enumerate(self.thresholds):
            kept &= scores[i] <= threshold
        return kept


def _threshold(counts: pd.DataFrame, good: int, bad: int, spare: float) -> float:
    """From counts of good and bad rows by score, highest first."""
    lost, caught = counts["good"].cumsum(), counts["bad"].cumsum()
    gain = (caught / bad - lost / good).where((lost <= spare * good) & (caught > lost), -1.0)
    if not len(gain) or gain.max() <= 0:
        return 1.0
    last = int(gain.to_numpy().argmax())
    below = counts["s"].iloc[last + 1] if last + 1 < len(counts) else 0.0
    return float((counts["s"].iloc[last] + below) / 2)


def fit(labelled: DataFrame, stats: str, quality: str, key: str, max_rows: int = 4096, spare: float = 0.005, trees: int = 100) -> QualityModel:
    """A model of `labelled` rows: struct column `stats`, 0/1 column `quality`, sampling key `key`.

    The forests grow on at most `max_rows` rows, those whose key hashes smallest. The
    thresholds come from all labelled rows, as counts by rounded score. Rows that the base
    rules reject and rows without a label have no say in it. Without labelled rows of both
    kinds the model rejects nothing beyond the base rules.
    """
    rows = labelled.where(F.col(quality).isin(0, 1) & ~base_failed(F.col(stats)))
    sample = rows.orderBy(F.xxhash64(key), key, *(f"{stats}.{n}" for n in BASE)).limit(max_rows)
    forests = [grow(x, trees, seed=7 + i) for i, x in enumerate(features(sample.select(f"{stats}.*").toPandas()))]
    model = QualityModel(forests, [1.0] * len(forests))
    # Marked so, or the planner copies it into the filters below, and each task runs it twice, in two workers at once.
    scored = rows.select(quality, model.anomaly().asNondeterministic()(F.col(stats)).alias("scores"))
    for rule in range(len(forests)):
        # Rows that an earlier rule rejects are no reason for a later one.
        left = scored.where(reduce(and_, (F.col("scores")[i] <= t for i, t in enumerate(model.thresholds))))
        counts = left.groupBy(F.round(F.col("scores")[rule], 4).alias("s")).agg(
            F.sum(F.col(quality).cast("long")).alias("good"), F.sum(1 - F.col(quality).cast("long")).alias("bad")
        ).orderBy(F.desc("s")).toPandas()
        good, bad = int(counts["good"].sum()), int(counts["bad"].sum())
        if good and bad:
            model.thresholds[rule] = _threshold(counts, good, bad, spare)
    return model


def label_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """(key, stats, quality) of the labelled rows of `docs`; a label of a null id belongs to none."""
    own = small_batches(docs).select(F.col(doc_id).alias("key"), rule_statistics(F.col(text)).alias("stats"))
    told = labels.select(F.col(doc_id).alias("key"), F.col(quality).cast("int").alias("quality")).where("quality in (0, 1)")
    return own.join(told.groupBy("key").agg(F.min("quality").alias("quality")), "key")


def reject_poor(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of `docs` that base rules and model keep, with the columns they came with.

    Null and empty texts have no words and go. Repeated rows are judged alike.
    """
    name = free_name(docs, "kept")
    return small_batches(docs).withColumn(name, model.verdicts()(F.col(text))).where(name).drop(name)
