"""Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmart.operators.clean import conform
from starmart.schemas import TableSpec
from starmart.session import dropping_shuffles


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    sort_by: Sequence[str] = (),
    partitions: int | None = None,
    dynamic: bool = False,
) -> int:
    """Write a Parquet folder and return the number of rows written.

    A partitioned write is rebalanced first: rows of a folder come together, so that it gets few
    files, and a folder holding most of the rows is still split over many tasks. ``partitions`` (by
    default ``spark.sql.shuffle.partitions``) should be at least the data size divided by
    ``advisoryPartitionSizeInBytes``: then only folders larger than that are split, and small ones
    sharing a shuffle partition are not cut into pieces with them. ``sort_by`` orders rows inside
    each file for tighter row-group statistics. Rows are counted by the writing tasks themselves,
    once per task however often it was tried. ``dynamic`` makes ``overwrite`` replace only the folders
    that get rows.
    """
    done = write_observed(df, path, partition_by, mode, sort_by, partitions, dynamic)
    return int(done["n"])


def write_observed(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    sort_by: Sequence[str] = (),
    partitions: int | None = None,
    dynamic: bool = False,
    metrics: Sequence[Column] = (),
) -> dict[str, object]:
    """``write_parquet``, returning the rows written as ``n`` and further named aggregates over them.

    What the write has shuffled is deleted with its end.
    """
    out = df
    if partition_by:
        size = [partitions] if partitions else []
        out = out.hint("rebalance", *size, *[F.col(c) for c in partition_by])
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    written = Observation()
    out = out.observe(written, F.count(F.lit(1)).alias("n"), *metrics)
    writer = out.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with dropping_shuffles(df.sparkSession):
        writer.parquet(path, partitionBy=list(partition_by) or None)
    return dict(written.get)


def append(df: DataFrame, path: str, spec: TableSpec) -> int:
    """Add the rows of ``df``, cast to the columns of ``spec``."""
    return write_parquet(conform(df, spec), path, spec.partition_by, "append", spec.sort_by)
