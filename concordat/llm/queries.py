"""The registered queries of the ten operators, and of the pipeline, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, kneser_ney, mixing, packing, periods, quality, resampling, simhash, token_files, topk, toxicity, transducer, urls,
)
from .common import scratch, small_batches, written

# Fixed values of the contracts.
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
ODD_TEXT = "</s>[INST] ok [/INST]"
TOXIC_LIMIT = 0.7
WORD_END, BYTE_END = 1, 0
WINDOW = 1024
TOXIC_TRAIN = "crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1"
SCORE_TRAIN = "crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    stats = written(small_batches(docs).select("doc_id", quality.rule_statistics("text").alias("stats")), "stats")
    labels = table(spark, folder, "labels").where("quality in (0, 1) and doc_id is not null")
    labels = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = written(stats.join(labels, "doc_id").withColumnRenamed("doc_id", "key"), "labelled")
    model = quality.fit(labelled, "stats", "quality", "key")
    told = stats.withColumn("anomaly", model.anomaly()(F.col("stats")))
    return told.select(
        "doc_id", *(f"stats.{n}" for n in quality.BASE[:5]), quality.base_failed(F.col("stats")).alias("base_failed"),
        model.kept(F.col("stats"), F.col("anomaly")).alias("kept"), "anomaly",
    )


def op3_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.rule_table(spark, RULES))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.Mix(table(spark, folder, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


def op5_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    turns = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(ODD_TEXT).alias("text")) for i, r in enumerate(("user", "assistant"))]
    odd = spark.range(1).select(F.inline(F.array(*turns)))
    return chat.digests(chat.format_conversations(rows.unionByName(odd)))


def op7_tokens(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), out, tokenizer("word_bpe_49k.json"), WORD_END)
    return token_files.with_crc32(token_files.read_tokens(spark, out))


def op8_scores(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.log_probabilities(table(spark, folder, "documents"), F.expr(SCORE_TRAIN))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"), TOXIC_TRAIN)
    score = toxicity.scorer(model)(F.col("text"))
    told = docs.select("doc_id", F.coalesce(~F.expr(TOXIC_TRAIN), F.lit(False)).alias("held_out"), score.alias("s"))
    return told.select("doc_id", "held_out", "s.score", (F.col("s.score") >= TOXIC_LIMIT).cast("int").alias("predicted"), "s.evidence")


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"), BYTE_END, WINDOW)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_periods(spark: SparkSession, folder: str) -> DataFrame:
    return periods.run_digests(periods.collapse_runs(table(spark, folder, "documents"), rewrite=periods.repeat_tail))


def op13_transducer(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    coded = transducer.decode(transducer.encode(table(spark, folder, "documents"), path), path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", "n_tokens", F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash, op2_quality, op3_urls, op4_mixing, op5_topk, op6_chat, op7_tokens, op8_scores, op9_toxicity, op10_packing,
        op11_resampling, op12_periods, op13_transducer,
    )
}
