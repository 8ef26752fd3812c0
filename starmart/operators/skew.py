"""Splitting the hot keys of a join exactly.

AQE already splits a skewed join partition by map output once it has seen the sizes. Salting is for
the cases known beforehand: only hot keys are salted, so only their few rows of the other side are
repeated, and no row is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import dropping_shuffles, remove_dir, work_dir


def complete(keys: Sequence[str]) -> Column:
    """No part of the key is null, so the row can match at all."""
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.001) -> DataFrame:
    """Keys that hold more than ``share`` of all rows with a complete key.

    At most ``1 / share`` keys can, so they are found once, in one pass over the key columns, and
    come back as a local table that may be broadcast at any data size. Counts are combined before the
    shuffle and written, so that their total needs no second pass.
    """
    spark = df.sparkSession
    path = work_dir(spark, "key-counts")
    counts = df.filter(complete(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    with dropping_shuffles(spark):
        counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    total = counts.agg(F.sum("__n")).first()[0] or 0
    found = counts.filter(F.col("__n") > F.lit(share * total)).select(*keys)
    hot = spark.createDataFrame(found.collect(), found.schema)
    remove_dir(spark, path)
    return hot


def _flag(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    marks = hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], F.lit(True).alias("__hot"))
    same = [F.col(k) == F.col(f"__hot_{k}") for k in keys]
    return df.join(F.broadcast(marks), same, "left").drop(*[f"__hot_{k}" for k in keys])


def salt_left(df: DataFrame, hot: DataFrame, keys: Sequence[str], salts: int) -> DataFrame:
    """Add ``__salt``: a hash of the whole row for hot and for incomplete keys, 0 for all others.

    A hash, unlike a random number, sends a row to the same place when a lost task is run again.
    Exact copies of a row stay together; AQE, which splits by map output, separates those.
    """
    spread: Column = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
    flagged = _flag(df, hot, keys)
    wide = F.col("__hot") | ~complete(keys)
    return flagged.withColumn("__salt", F.when(wide, spread).otherwise(F.lit(0))).drop("__hot")


def salt_right(df: DataFrame, hot: DataFrame, keys: Sequence[str], salts: int) -> DataFrame:
    """Repeat the rows of hot keys once per salt; all other rows stay single."""
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    flagged = _flag(df, hot, keys)
    return flagged.withColumn(
        "__salt", F.explode(F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0))))
    ).drop("__hot")
