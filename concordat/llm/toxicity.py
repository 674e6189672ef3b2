"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Labelled training rows give the examples, a sample of bounded size. Terms are words and their
beginnings (a root with many endings is one term); those kept as vocabulary tell the labels of
the sample apart beyond chance. Inverse document frequencies of the vocabulary come from all
documents. The index holds, for each term, its postings in blocks of examples and the greatest
weight in each block; a query visits blocks in order of their bound and stops when no block can
hold a nearer example, so the neighbours are exact. Their votes, weighted by closeness, are
mapped to a probability by the leave-one-out votes of the examples themselves.

Vocabulary and examples are bounded, so the index is sent to every task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, pieces, small_batches

# ASCII letters lower-cased and digits stay, other ASCII turns to spaces, other bytes stay.
FOLD = bytes(
    ord(chr(i).lower()) if i < 128 and chr(i).isalnum() else 32 if i < 128 else i for i in range(256)
)
ROOTS = range(4, 9)  # lengths in bytes of the beginnings that are terms


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def terms(word: bytes) -> list[bytes]:
    """The word, and its beginnings marked as such."""
    return [word, *(word[:n] + b"*" for n in ROOTS if len(word) >= n)]


class Vocabulary:
    """Numbers of terms; remembers the numbers of each word it has met."""

    def __init__(self, names: list[bytes], limit: int = 150_000):
        self.number = {t: i for i, t in enumerate(names)}
        self.limit = limit
        self.met: dict[bytes, tuple[int, ...]] = {}

    def count(self, text: str | None) -> dict[int, int]:
        """Times of each vocabulary term in the text."""
        own, met = Counter(words(text)), self.met
        if len(met) > self.limit:
            met.clear()
        for w in own:
            if w not in met:
                met[w] = tuple(self.number[t] for t in terms(w) if t in self.number)
        out: dict[int, int] = {}
        for w, n in own.items():
            for t in met[w]:
                out[t] = out.get(t, 0) + n
        return out

    def __getstate__(self):
        return {**self.__dict__, "met": {}}


@dataclass
class Index:
    """Unit TF-IDF vectors of the examples, by term, with block maxima."""

    idf: np.ndarray
    labels: np.ndarray
    block: int
    n_blocks: int = 0
    doc: np.ndarray | None = None
    weight: np.ndarray | None = None
    cut: list | None = None  # where the postings of (term, block) begin
    most: np.ndarray | None = None  # greatest weight of (term, block)

    @staticmethod
    def build(counts: list[dict[int, int]], labels: np.ndarray, idf: np.ndarray, block: int = 512) -> Index:
        index = Index(idf, labels, block)
        vectors = [index.unit(c) for c in counts]
        term = np.array([t for v in vectors for t in v], np.int64)
        doc = np.repeat(np.arange(len(vectors)), [len(v) for v in vectors])
        weight = np.array([w for v in vectors for w in v.values()], float)
        order = np.lexsort((doc, term))
        term, index.doc, index.weight = term[order], doc[order], weight[order]
        index.n_blocks = -(-len(vectors) // block)
        cell = term * index.n_blocks + index.doc // block
        index.cut = np.searchsorted(cell, np.arange(len(idf) * index.n_blocks + 1)).tolist()
        index.most = np.zeros(len(idf) * index.n_blocks)
        np.maximum.at(index.most, cell, index.weight)
        index.most = index.most.reshape(len(idf), index.n_blocks)
        return index

    def unit(self, counts: dict[int, int]) -> dict[int, float]:
        raw = {t: (1 + math.log(n)) * float(self.idf[t]) for t, n in sorted(counts.items())}
        size = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / size for t, w in raw.items()} if size else {}

    def nearest(self, query: dict[int, float], k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above zero, ties to the earlier, and their cosines; never `but`."""
        if not query:
            return np.empty(0, np.int64), np.empty(0)
        bound = np.array(list(query.values())) @ self.most[list(query)]
        ids, scores = np.empty(0, np.int64), np.empty(0)
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(ids) == k and bound[b] < scores[-1] - 1e-12:
                break
            got = np.zeros(self.block)
            for t, w in query.items():
                low, high = self.cut[t * self.n_blocks + b], self.cut[t * self.n_blocks + b + 1]
                if low < high:
                    got[self.doc[low:high] - b * self.block] += w * self.weight[low:high]
            own = np.flatnonzero(got > (scores[-1] - 1e-12 if len(ids) == k else 0))
            own = own[own + b * self.block != but]
            ids, scores = np.append(ids, own + b * self.block), np.append(scores, got[own])
            best = np.lexsort((ids, -scores.round(12)))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores


@dataclass
class ToxicityModel:
    vocabulary: Vocabulary
    index: Index
    example_ids: list
    k: int
    prior: float  # score of a text without vocabulary terms
    steps: np.ndarray  # calibrated probability of each tenth of the raw vote
    known: dict = field(default_factory=dict)

    def vote(self, query: dict[int, float], but: int = -1) -> tuple[float | None, np.ndarray]:
        ids, near = self.index.nearest(query, self.k, but)
        if not len(ids):
            return None, ids
        weight = 1 / (1.001 - np.minimum(near, 1.0))
        return float((weight * self.index.labels[ids]).sum() / weight.sum()), ids

    def calibrated(self, raw: float | None) -> float:
        if raw is None:
            return self.prior
        return float(np.interp(raw, np.linspace(0, 1, len(self.steps)), self.steps))

    def score(self, text: str | None) -> tuple[float, list]:
        """Probability of the toxic label, and the ids of the examples that voted."""
        counts = self.vocabulary.count(text)
        key = tuple(sorted(counts.items()))
        if key not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            raw, ids = self.vote(self.index.unit(counts))
            self.known[key] = (self.calibrated(raw), [self.example_ids[i] for i in ids])
        return self.known[key]

    def __getstate__(self):
        return {**self.__dict__, "known": {}}


def _monotone(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing steps (pool adjacent violators)."""
    held: list[list[float]] = []
    for v, w in zip(value, weight):
        held.append([v, w, 1])
        while len(held) > 1 and held[-2][0] > held[-1][0]:
            v2, w2, n2 = held.pop()
            v1, w1, n1 = held.pop()
            held.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in held])


def _distinct(ranked: list[tuple[float, bytes]]) -> list[tuple[float, bytes]]:
    """Of terms that begin alike and tell the labels apart equally well, which are as good as one, the first."""
    seen, out = set(), []
    for z, t in ranked:
        if (mark := (z, t[: ROOTS[0] - 1])) not in seen:
            seen.add(mark)
            out.append((z, t))
    return out


def fit(
    docs: DataFrame, labels: DataFrame, train: str, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    max_examples: int = 16384, max_terms: int = 2048, least_z: float = 6.0, k: int = 15,
) -> ToxicityModel:
    """A model from the labelled rows of `docs` for which the SQL condition `train` on `doc_id` holds.

    At most `max_examples` rows are examples, those whose id hashes smallest (all of them where
    there are fewer). Labels other than 0 and 1, null ids and labels without a text teach
    nothing; a document labelled both ways counts as toxic. Without examples every score is
    zero, without toxic ones the share of toxic examples.
    """
    told = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    told = told.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = told.where(train).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    own = small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sample = own.join(F.broadcast(chosen), "doc_id")

    def spell(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in pieces(stream):
            for t, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                tally[y].update({x for w in set(words(t)) for x in terms(w)})
                tally[y][b" "] += 1  # the row itself
        names = list(tally[0].keys() | tally[1].keys())
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), *(pa.array([tally[y][t] for t in part], pa.int64()) for y in (1, 0))],
                ["term", "toxic", "clean"],
            )

    spelt = sample.select("text", "label").mapInArrow(spell, "term binary, toxic long, clean long")
    counted = spelt.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    top = counted.where("toxic >= 3 or term = cast(' ' as binary)").orderBy(
        F.desc(F.col("term") == F.lit(b" ")), F.desc(F.col("toxic") / (F.col("toxic") + F.col("clean") + 1) * F.sqrt("toxic")), "term"
    ).limit(8 * max_terms).collect()
    n1, n0 = (top[0]["toxic"], top[0]["clean"]) if top and bytes(top[0]["term"]) == b" " else (0, 0)
    scored = []
    for row in top[1:] if n1 and n0 else []:
        a, b = row["toxic"], row["clean"]
        share = (a + b) / (n1 + n0)
        z = (a / n1 - b / n0) / math.sqrt(max(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
        scored.append((-z, bytes(row["term"])))
    # A small sample cannot reach a high z; in a large one, chance words of often copied texts pass a low one.
    floor = max(min(least_z, math.sqrt(n1 + n0) / 8), 0.25 * max((-z for z, _ in scored), default=0.0))
    vocabulary = Vocabulary([t for _, t in _distinct(sorted(x for x in scored if -x[0] >= floor))][:max_terms])
    size = len(vocabulary.number)

    def meet(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(size + 1, np.int64), 0
        for batch in pieces(stream):
            for t in batch.column("text").to_pylist():
                rows += 1
                df[list(vocabulary.count(t))] += 1
        df[size] = rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(df)], ["t", "n"])

    found = dict(own.select("text").mapInArrow(meet, "t long, n long").groupBy("t").agg(F.sum("n")).collect())
    df = np.array([found.get(t, 0) for t in range(size)], float)
    idf = np.log((1 + found.get(size, 0)) / (1 + df)) + 1

    def look(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(stream):
            counts = [vocabulary.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([list(c.items()) for c in counts], pa.map_(pa.int32(), pa.int32()))],
                ["doc_id", "label", "counts"],
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    seen = sample.select("doc_id", "label", "text").mapInArrow(look, f"doc_id {kind}, label int, counts map<int,int>").toPandas()
    # Examples of like terms stand together, which makes the blocks' bounds tight; equal ones by id, as the earlier wins a tie.
    seen["terms"] = [tuple(sorted(c)) for c in seen["counts"]]
    seen = seen.sort_values(["terms", "doc_id"], kind="stable")
    counts = [dict(c) for c in seen["counts"]]
    y = seen["label"].to_numpy(float)
    index = Index.build(counts, y, idf)
    blank = np.array([not c for c in counts], bool)
    prior = float((y[blank].sum() + 0.5 * y.mean()) / (blank.sum() + 0.5)) if len(y) else 0.0
    model = ToxicityModel(vocabulary, index, list(seen["doc_id"]), k, prior, np.linspace(0, 1, 11))
    if len(y):
        # Leave-one-out votes; examples with equal counts share a vector, so each meets the others.
        raw = [model.vote(index.unit(c), i)[0] for i, c in enumerate(counts)]
        pairs = [(r, t) for r, t in zip(raw, y) if r is not None]
        if pairs:
            r, t = np.array(pairs).T
            bins = np.round(r * 10).astype(int)
            n = np.bincount(bins, minlength=11)
            hit = np.bincount(bins, weights=t, minlength=11)
            model.steps = _monotone((hit + np.linspace(0, 1, 11)) / (n + 1), n + 1.0)
    return model


def scorer(model: ToxicityModel):
    """A function of a text column: struct of score (0 to 1) and evidence (ids of the examples that voted, as text)."""

    @F.pandas_udf("score double, evidence array<string>")
    def score(text: pd.Series) -> pd.DataFrame:
        found = [model.score(t) for t in text]
        return pd.DataFrame({"score": [s for s, _ in found], "evidence": [[str(i) for i in ids] for _, ids in found]})

    return score


def reject_toxic(docs: DataFrame, model: ToxicityModel, limit: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of `docs` that score below `limit`, with the columns they came with. Null and empty texts score as
    texts without a vocabulary term; repeated rows score alike."""
    name = free_name(docs, "toxicity")
    return docs.withColumn(name, scorer(model)(F.col(text))).where(F.col(name)["score"] < limit).drop(name)
