"""A training corpus from ``documents``: one (name, function) stage after the other.

Each function takes (spark, docs, sf_dir) and returns a frame; each result is
written as Parquet to the shared folder and read again as the next one's docs.
Columns of ``documents`` stay the same up to the last stage, which encodes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import bpe, mixing, neardup, quality, substring
from shelfmark.operators.settle import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts."""
    return quality.accepted(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints (3-word shingles, 3 bits): the smallest id."""
    return neardup.one_of_each(docs.select(COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier; every document stays, if only with what is left of it."""
    kept = substring.remove_repeats(docs, keep=("lang", "source"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    return mixing.mixed(docs.select(COLUMNS))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with their number; source and language stay beside them."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id", "lang", "source"])


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encoding", bpe_encoding),
]
#: Scores, draws and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
