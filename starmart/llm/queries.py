"""The registered queries of the text operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    chunk_dedup,
    dual_tree,
    fertility,
    fingerprints,
    licenses,
    line_dedup,
    mixing,
    pieces,
    ranking,
    repair,
    simhash,
    toxicity,
    urls,
)
from starmart.llm.common import table
from starmart.llm.oracles import LLM_ORACLES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines taken out of all documents; a document's source is its site."""
    cleaned = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return cleaned.select("doc_id", "n_lines", "n_removed", digest)


def op2_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents."""
    rated = fertility.rate(table(spark, sf_dir, "documents"))
    contract = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["n_tokens", "chars_per_token", "byte_share", "entropy", "chars_per_byte_token", "partial_share"]
    return rated.select(*contract, "base_failed", "kept", *more)


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return pieces.digest(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents."""
    return chunk_dedup.duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their source's target and the words that the mix takes of each."""
    plan = mixing.mixing_plan(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    docs = table(spark, sf_dir, "documents")
    return ranking.score(docs, ranking.train(docs, table(spark, sf_dir, "labels")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the url of every page."""
    judge = urls.fit(urls.labelled_urls(spark))
    return judge.judge(table(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for each benchmark item."""
    return dual_tree.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged by a rule, then repaired."""
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(conversations), conversations)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_fertility,
        op3_pieces,
        op4_license_scan,
        op5_exact_dedup,
        op6_source_mix,
        op7_toxicity,
        op8_simhash,
        op9_quality,
        op10_url_filter,
        op11_ranked_search,
        op12_fingerprints,
        op13_repair,
    )
}
