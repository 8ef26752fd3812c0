"""What the text operators share: reading, written intermediates, word forms, row keys."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import work_dir

# White space between words, as Java and SQL pattern.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"
# Rows (of a few numbers each) up to which a counted table is broadcast.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read again.

    Cuts the lineage: a lost executor costs only the tasks that read from it, and every later
    reader sees the same rows in the same files. The folder belongs to whoever owns the shared
    folder; the frame is lazy, so it cannot be removed here.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows it to be small; else Spark decides."""
    return F.broadcast(df) if df.count() <= rows else df


def spaces(text: Column) -> Column:
    """Number of spaces."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` as bigint; null counts as empty."""
    framed = F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))
    return (spaces(F.regexp_replace(framed, GAP, " ")) - 1).cast("bigint")


def text_key(text: Column) -> Column:
    """With the id it tells rows apart: rows equal in both are copies of one another."""
    return F.xxhash64(text)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column (letter case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decided`` keeps, with all columns, whatever their names.

    ``decided`` has ``doc_id``, ``text_key`` and ``kept``, one row per row of ``docs``. A key with a
    kept row comes out once, however often it is repeated. Only keys that go or are repeated are
    joined, broadcast if a count shows them to be few; then no text is shuffled.
    """
    keys = decided.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")
    )
    odd = stored(keys.filter("not kept or n > 1"), "odd-keys")
    # The columns of docs travel in one struct, so that none clashes with a key.
    packed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), text_key(F.col("text")).alias("own_key")
    )
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key"))
    left = packed.join(small(odd), same, "left_anti").select("row.*")
    repeated = odd.filter("kept")
    if repeated.isEmpty():
        return left
    once = packed.join(small(repeated), same, "left_semi").dropDuplicates(["own_id", "own_key"])
    return left.unionByName(once.select("row.*"))


def package_root() -> str:
    """The folder that holds this package, for Python workers started elsewhere."""
    return str(Path(__file__).resolve().parents[2])
