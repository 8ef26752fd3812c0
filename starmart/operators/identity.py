"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import hash_key
from starmart.session import work_dir

KINDS = ("hash", "sequence", "monotonic")


def _sequence(
    df: DataFrame, name: str, start: int, order_by: Sequence[str], scratch: str | None
) -> DataFrame:
    spark, columns = df.sparkSession, [c for c in df.columns if c != name]
    rows = df.select(*columns)
    if order_by:
        # The input partition as last range column splits rows of equal order over several tasks.
        spread = rows.withColumn("__from", F.spark_partition_id())
        rows = spread.repartitionByRange(*order_by, "__from").sortWithinPartitions(*order_by).drop("__from")
    path = scratch or work_dir(spark, "sequence")
    rows.write.parquet(path)
    # The number within the file and the file itself are facts of the written table: they stay the
    # same however the table is split for reading and whatever task is run again.
    fixed = spark.read.schema(rows.schema).parquet(path).withColumns(
        {"__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")}
    )
    counts = fixed.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    # One row per written file; Spark broadcasts the offsets if they turn out to be small.
    task = F.regexp_extract("__file", r"part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(task, "__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    number = F.lit(start) + F.col("__offset") + F.col("__row")
    return fixed.join(offsets, "__file").select(*columns, number.alias(name))


def add_id(
    df: DataFrame,
    kind: str = "hash",
    name: str = "id",
    cols: Sequence[str] = (),
    start: int = 1,
    order_by: Sequence[str] = (),
    scratch: str | None = None,
) -> DataFrame:
    """Add a bigint key column.

    ``hash``: of ``cols``, the same in every run, no pass over the data. 64 bits: two of n keys
    collide with probability about n² / 2^65, so past some hundred million rows treat it as a label
    beside the business key, or use ``sequence``.
    ``sequence``: dense from ``start``. Writes the rows to the shared checkpoint folder, counts them
    per file (from the footers) and adds offsets; no shuffle and no window over the rows.
    ``order_by`` adds a range shuffle so that the numbers follow that order. The rows are written to
    ``scratch`` if given, which the caller may remove once the result is used up.
    ``monotonic``: unique in this frame from ``start``, with gaps; not repeatable between runs.
    """
    if kind == "hash":
        if not cols:
            raise ValueError("a hash id needs cols")
        return df.withColumn(name, hash_key(cols))
    if kind == "monotonic":
        return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start))
    if kind == "sequence":
        return _sequence(df, name, start, order_by, scratch)
    raise ValueError(f"kind is one of {KINDS}, not {kind!r}")
