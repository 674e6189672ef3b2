"""Base statistics against a plain count, and what the forest tells apart."""

import re

import numpy as np

from concordat.llm import quality
from concordat.llm.common import written
from concordat.llm.queries import op2_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, copies = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        copies += line in seen
        seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(covered), len(lines))


def test_statistics(documents):
    texts = [t for _, t in documents] + ["a a a", "a a a a", "x y z x y z", "l\nl\n l\n\nl", "a\x85b c d"]
    for text in texts:
        assert quality.measure(text) == plain(text)


def test_query_keeps_good_and_drops_poor(spark, folder):
    rows = {r.doc_id: r for r in op2_quality(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    for r in rows.values():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    good = [rows[x.doc_id] for x in labels if x.quality == 1]
    poor = [rows[x.doc_id] for x in labels if x.quality == 0]
    assert np.mean([r.kept for r in good if not r.base_failed]) > 0.97
    assert np.mean([r.kept for r in poor]) < 0.2


def test_path_lengths_single_out_an_outlier():
    rng = np.random.default_rng(2)
    rows = np.vstack([rng.normal(size=(500, 3)), [[9, 9, 9]]])
    score = quality.grow(rows, 50).score(rows)
    assert score.argmax() == 500 and score[500] > 0.6


def test_without_labels_only_base_rules_reject(frame):
    docs = frame([(1, "a b " * 10), (2, " ".join(map(str, range(80)))), (3, None), (2, " ".join(map(str, range(80))))]).selectExpr("*", "doc_id as stats", "text as rule_statistics")
    labels = frame([], "doc_id long, quality int")
    model = quality.fit(quality.label_rows(docs, labels), "stats", "quality", "key")
    kept = quality.reject_poor(docs, model)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 2] and kept.columns == docs.columns
    assert quality.reject_poor(docs.limit(0), model).collect() == []


def test_scores_of_a_labelled_row_are_made_once(spark, folder, monkeypatch):
    plans, kind = [], type(spark.range(1))
    plain = kind.toPandas
    monkeypatch.setattr(kind, "toPandas", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or plain(self))
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    labelled = written(quality.label_rows(docs, labels), "labelled")
    quality.fit(labelled, "stats", "quality", "key")
    assert len(plans) == 4 and max(p.count("ArrowEvalPython") for p in plans) == 1
