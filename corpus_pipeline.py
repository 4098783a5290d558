"""A training corpus from raw documents: good texts, without copies, mixed by source, packed into sequences.

Every stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns the columns of documents;
the last returns the pieces of the packed sequences. Between stages documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ouvidoria.llm import exact_dedup, mixing, near_copies, packing, quality
from ouvidoria.llm.common import staged, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject; it is fitted on labelled documents that reach this stage."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose texts are equal but for white space, the one with the smallest doc_id."""
    return exact_dedup.distinct_documents(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id.

    Candidates by SimHash components and MinHash bands, confirmed on five-word shingles: Jaccard similarity 0.8 or more.
    """
    return near_copies.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.best_fit_sequences(docs)


STAGES = [
    ("quality classifier", good),
    ("exact dedup", unique),
    ("near-duplicate removal", unlike),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]

# Training, fingerprints and token ids are beyond SQL; tests hold every stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
