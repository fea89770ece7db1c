"""A corpus prepared for training: toxic documents go, then exact copies, then near copies; the
rest is mixed by source and packed into sequences.

Each stage is written to the shared folder and read back before the next one, so a lost
executor costs tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entityframe.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from entityframe.llm.common import load, stage
from entityframe.sources.staging import release, staged_count


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of rejection stay."""
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-equal texts the one with the smallest doc_id stays."""
    return ngram_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in the training sequences."""
    return packing.pack_documents(docs).drop("text_hash")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: Neither the scores nor the packing can be expressed in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    before = staged_count(spark)
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline")
        # What led to this table is not read again.
        release(spark, before, newest=1)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
