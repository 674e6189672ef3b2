import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark, folder):
    """(doc_id, text) of the smallest documents table, and a few odd ones."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    odd = [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "one"), (-5, "a b"), (-6, "word " * 30_000), (-6, "word " * 30_000), (None, "no id here"), (-8, "É ß 漢字 <|endoftext|> # # #\n\nx\n")]
    return rows + odd


@pytest.fixture
def frame(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(list(rows), schema)

    return make
