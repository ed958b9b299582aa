"""Corpus pipeline: documents through quality rules, near-dedup, decontamination,
secret scan and encoding. Each stage is one operator of ``ridelake.llm`` on all
that its predecessor kept; its output is a written table that the next one reads."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import bpe_codec, decontaminate, host_quality, secrets, simhash
from ridelake.llm.common import read, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and their host's verdict keep."""
    judged, names = host_quality.judge(docs)
    return judged.where(F.col(names["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of linked fingerprints."""
    return simhash.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, reported secrets replaced by a marker; n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token ids of each document."""
    return bpe_codec.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

ORACLE_SQL = None    # SQL can express neither the fingerprints' links nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
