"""The corpus pipeline: documents in, packed sequences out, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All stages but the last return the columns that they
were given, extra ones of any name included. An empty table gives an empty table in every stage.
Texts of any length are worked on whole, and a null may stand in any column; each stage says what
becomes of null and empty texts, of ties and of repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from concordat.llm import mixing, packing, quality, simhash, toxicity
from concordat.llm.common import written
from concordat.llm.queries import BYTE_END, TOXIC_LIMIT, TOXIC_TRAIN, WINDOW, table, tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not make toxic, those that score below the limit.

    Null and empty texts, and texts without a term of the model, score as one, so all go or all stay. Repeated rows
    score alike and stay as often as they came. A null id has no label. A score equal to the limit is rejected.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), TOXIC_TRAIN)
    return toxicity.reject_toxic(docs, model, TOXIC_LIMIT)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rules and isolation forest keep.

    Null and empty texts, and all of less than 50 words, go. Repeated rows are judged alike and stay as often as they
    came. Without labels of both kinds the base rules alone decide.
    """
    labelled = written(quality.label_rows(docs, table(spark, sf_dir, "labels")), "labelled")
    return quality.reject_poor(docs, quality.fit(labelled, "stats", "quality", "key"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8.

    The document of the smallest id stays, a null id last; of rows that repeat an id any one. Null texts, empty texts
    and texts of blanks are copies of each other; shorter texts are compared by all their words.
    """
    return simhash.similar_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the target weights of the sources take of each document, as often as they take it.

    A document without words, a null text among them, has nothing to take and goes. A null source is a source, the last.
    Repeated rows are documents of their own. Reruns over the same rows agree.
    """
    return mixing.mixed_rows(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of up to 1024 tokens.

    A null or empty text is one piece of its end id. Repeated rows, and rows of a null id, are documents of their own.
    """
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), BYTE_END, WINDOW)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# No stage is expressible in SQL: models, fingerprints, pseudorandom draws and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
