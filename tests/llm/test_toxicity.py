"""Neighbours against all cosines, and held-out labels."""

import numpy as np

from concordat.llm import toxicity
from concordat.llm.queries import TOXIC_TRAIN, op9_toxicity


def test_neighbours_are_exact():
    rng = np.random.default_rng(3)
    counts = [{int(t): int(rng.integers(1, 4)) for t in rng.integers(0, 30, rng.integers(0, 8))} for _ in range(500)]
    idf = rng.uniform(1, 5, 30)
    index = toxicity.Index.build(counts, rng.integers(0, 2, 500).astype(float), idf, block=16)
    dense = np.zeros((500, 30))
    for i, c in enumerate(counts):
        for t, w in index.unit(c).items():
            dense[i, t] = w
    for i, c in enumerate(counts[:200]):
        cosine = dense @ dense[i]
        ids, near = index.nearest(index.unit(c), 10)
        order = np.lexsort((np.arange(500), -cosine.round(12)))[:10]
        order = order[cosine[order] > 0]
        assert ids.tolist() == order.tolist() and np.allclose(near, cosine[order])


def test_held_out_labels(spark, folder):
    folder = folder if "0.001" not in folder else folder.replace("0.001", "0.01")
    rows = {r.doc_id: r for r in op9_toxicity(spark, folder).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if rows[r.doc_id].held_out]
    caught = np.mean([rows[r.doc_id].predicted for r in labels if r.toxic == 1])
    wrong = np.mean([rows[r.doc_id].predicted for r in labels if r.toxic == 0])
    assert wrong < 0.03 and caught > 0.5


def test_odd_rows_and_no_examples(frame):
    docs = frame([(1, None), (2, ""), (3, "fine words"), (3, "fine words"), (None, "x")]).selectExpr("*", "text as toxicity", "doc_id as label")
    none = toxicity.fit(docs, frame([], "doc_id long, toxic int"), TOXIC_TRAIN)
    kept = toxicity.reject_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == 5
    labels = frame([(1, 0), (2, None), (3, 1), (3, 0), (None, 1), (9, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, "true")
    assert toxicity.reject_toxic(docs, model).count() <= 5
    assert toxicity.fit(docs.limit(0), labels, "true").score("x")[0] == 0.0


def test_ties_go_by_id_not_by_label(frame):
    """Of forty equal examples, half of them toxic, those of the smallest ids vote."""
    docs = frame([(i, "vile filthy rotten words here") for i in range(40)] + [(100 + i, "calm kind gentle words here") for i in range(200)])
    labels = frame([(i, i % 2 if i < 40 else 0) for i in [*range(40), *range(100, 300)]], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, "true", least_z=1.0)
    score, voters = model.score("vile filthy rotten words here")
    assert voters == list(range(15)) and 0.2 < score < 0.8
