"""From raw documents to token ids: toxic texts out, copies and near copies out, sources mixed, encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import chunk_dedup, mixing, pieces, simhash, toxicity
from starmart.llm.common import stored, table

# SQL cannot express the classifier, the fingerprints and the encoding.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return chunk_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at four bits or fewer."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources come near their targets."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with what decoding them gives."""
    return pieces.digest(docs, ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read by the next.

    An empty table gives an empty result. Nulls, empty and very long texts and repeated rows are
    treated as each stage's operator says; further columns travel along to the last stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
