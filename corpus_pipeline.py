"""The corpus pipeline: toxicity, n-gram Jaccard join, PII, mixing, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import bpe, common, mixing, ngram_jaccard, pii, queries, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents judged toxic go; the model learns from all labels outside the held-out fifth."""
    labels = common.table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.train(docs, labels)
    return toxicity.score(docs, model, out_col="__toxic").where(F.col("__toxic") < 0.5).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of the documents that near-copies link, the one with the smallest doc_id stays."""
    return ngram_jaccard.keep_one(docs, n=5, ratio=(80, 100)).select(*COLUMNS)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: personal data and the words that disclose it are taken out of the texts."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents sampled so that sources, languages and topics meet their target weights."""
    return mixing.mix(docs).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token ids, and their round trip back to the text's bytes."""
    return bpe.digests(docs, queries.RANKS, queries.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("pii", remove_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", tokenise),
]

#: SQL can't express the trained model and the token merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    import uuid

    docs = common.table(spark, sf_dir, "documents")
    folder = f"{common.checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
