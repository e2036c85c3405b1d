"""A training corpus from ``documents``: quality, near duplicates, mix, packing.

Each stage reads what the one before it wrote; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelmart.llm import minhash, mixing, packing, quality
from panelmart.llm.common import cut_lineage, prepare, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.keep_good(docs, quality.good_labels(table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: five-word shingles,
    similarity of 0.8 or more."""
    return minhash.deduplicate(docs, n_words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, in the mix's
    shards and shuffled within them."""
    return mixing.mixed_rows(docs).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids with their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: SQL can't express the tokenizer, the classifier or the draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are a written table."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
