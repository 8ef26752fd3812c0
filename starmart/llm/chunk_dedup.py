"""Exact deduplication by recipes of content-defined chunks.

A text is cut where its content says so, chunks are deduplicated to identifiers of 128 bits, and the
identifiers are verified: no two different chunks may share one. Then texts are compared by their
ordered lists of identifiers. Chunk texts move once, each distinct chunk once per task; after that a
document is 16 bytes per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import GAP, keep_rows, stored, text_key

# A chunk ends after a comma or full stop and a space, between 256 and 2048 characters.
CHUNK = r"(?s).{256,2048}?[,.] |.{1,2048}"
SEEDS = 4


def normal(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def chunks(text: Column, pattern: str = CHUNK) -> Column:
    """The text cut into chunks; joined they give the text again."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_id(chunk: Column, seed: int) -> Column:
    """128 bits as two numbers."""
    return F.array(F.xxhash64(F.lit(seed), chunk), F.xxhash64(F.lit(-1 - seed), chunk))


def ids_verified(docs: DataFrame, seed: int, pattern: str = CHUNK) -> bool:
    """True if no two different chunks of ``docs`` have the same identifier."""
    chunk = docs.select(F.explode(chunks(normal(F.col("text")), pattern)).alias("chunk"))
    number = chunk_id(F.col("chunk"), seed)
    distinct = chunk.select(number[0].alias("a"), number[1].alias("b"), "chunk").distinct()
    shared = distinct.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return shared.isEmpty()


def recipes(docs: DataFrame, pattern: str = CHUNK) -> DataFrame:
    """``row``, ``doc_id``, ``text_key``, ``text_sha256`` and ``recipe`` of each row, written."""
    for seed in range(SEEDS):
        if ids_verified(docs, seed, pattern):
            break
    else:
        raise RuntimeError("chunk identifiers collide under every seed")
    texts = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), normal(F.col("text")).alias("normal")
    )
    cut = chunks(F.col("normal"), pattern)
    recipe = F.flatten(F.transform(cut, lambda c: chunk_id(c, seed)))
    return stored(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text_key",
            F.sha2("normal", 256).alias("text_sha256"),
            recipe.alias("recipe"),
        ),
        "recipes",
    )


def duplicates(docs: DataFrame, pattern: str = CHUNK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_key``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``.

    Texts are equal when identical after each run of white space became one space; null counts as
    empty. Of equal texts the row with the smallest ``doc_id`` stays (null ids last); of repeated rows
    with that id exactly one does. Groups are counted before the shuffle and joined back by recipe,
    where Spark splits a hot group. Other columns are ignored; an empty table gives no rows.
    """
    rows = recipes(docs, pattern)
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    groups = (
        rows.groupBy("recipe")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    # Written, so that the join has nothing but shuffles below it and a hot recipe is split.
    groups = stored(groups, "equal-recipes")
    alone = F.col("n").isNull()
    return rows.join(groups, "recipe", "left").select(
        "doc_id",
        "text_key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("first.row"))).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    return keep_rows(docs, duplicates(docs))
