"""The pipeline over the smallest tables."""

from collections import Counter

import pytest

import corpus_pipeline
from concordat.llm.common import written


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = written(stage(spark, docs, folder), name)
        assert made.columns == docs.columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert {r.doc_id for r in made.select("doc_id").collect()} <= ids
        docs = made
        sizes.append(docs.count())
    assert sizes[1] <= sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}


LONG = " ".join(f"w{i}" for i in range(60_000))
PROSE = " ".join(f"reader{i % 71} follows{i % 13} plainly{i % 29}" for i in range(120))
ODD = [
    (1, None, "en", "web", 0), (2, "", "en", "web", 0), (3, " \n\t ", None, None, None), (4, "one", "en", "web", 3),
    (5, LONG, "en", None, None), (5, LONG, "en", None, None), (None, PROSE, "en", "books", 9), (7, PROSE, "en", "books", 9),
    (7, PROSE, "en", "books", 9), (8, PROSE.replace("reader3", "writer3"), None, "news", 9), (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with extra columns named as the stages' own."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr(
        "*", "doc_id as row_number", "text as outline", "lang as kept", "source as toxicity", "doc_id as runs", "doc_id as ids",
        "text as stats", "doc_id as size", "doc_id as uid", "doc_id as node", "text as start",
    )


def of(rows):
    return Counter((r.doc_id, r.text) for r in rows)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, folder, odd, name, stage):
    made = stage(spark, odd, folder)
    rows = made.collect()
    given = Counter((r[0], r[1]) for r in ODD)
    if name == "packing":
        whole = Counter()
        for r in rows:
            whole[r.doc_id] += r.length
        expected = Counter()
        for r in {(r.doc_id, r.doc_tokens): r for r in rows}.values():
            expected[r.doc_id] += r.doc_tokens * sum(x.start == 0 and (x.doc_id, x.doc_tokens) == (r.doc_id, r.doc_tokens) for x in rows)
        assert whole == expected and whole[1] == whole[2] == 1
        assert sum(r.start == 0 for r in rows) == len(ODD)
        assert {r.doc_id for r in rows} == {r[0] for r in ODD}
        return
    assert made.columns == odd.columns
    kept = of(rows)
    if name == "toxicity":
        assert all(kept[k] == given[k] for k in kept)
        assert len({(1, None) in kept, (2, "") in kept, (3, " \n\t ") in kept, (None, None) in kept}) == 1
    elif name == "quality":
        assert all(kept[k] == given[k] for k in kept)
        assert all(len((text or "").split()) >= 50 for _, text in kept) and kept[(5, LONG)] == 2
    elif name == "near_duplicates":
        assert kept == Counter({(1, None): 1, (4, "one"): 1, (5, LONG): 1, (7, PROSE): 1} | ({k: 1 for k in kept if k[0] == 8}))
    else:
        assert set(kept) and all((text or "").split() for _, text in kept)
        assert {i for i, _ in kept} <= {None, 4, 5, 7, 8}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_table(spark, folder, odd, name, stage):
    made = stage(spark, odd.limit(0), folder)
    assert made.collect() == [] and (name == "packing" or made.columns == odd.columns)
