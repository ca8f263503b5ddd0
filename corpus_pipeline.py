"""Corpus pipeline: quality rules, near-dedup, PII, mixing, BPE.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir) and works on
all rows that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landroll.llm import bpe, mixing, pii, quality, simhash
from landroll.llm.common import fresh_path, scratch, table
from landroll.llm.queries import TOKENIZER
from landroll.session import drop_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row"))
    return quality.judge(rows, table(spark, sf_dir, "labels"), keep=("__row",)).where("kept").select("__row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row for each whole pass over a document, and one for its extra blocks."""
    return mixing.taken_texts(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row and the text decoded from them."""
    coded = bpe.encode_decode(docs, public_tokenizers.path(TOKENIZER), keep=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("bpe_codec", bpe_codec),
]

# The verdict of the quality rules, the fingerprints and the tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the tables of a stage are dropped once its successor is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with scratch(spark):
            done = stage(spark, docs, sf_dir)
            done.write.mode("error").parquet(path)
        if before:
            drop_path(spark, before)
        docs, before = spark.read.schema(done.schema).parquet(path), path
    return docs
