"""A persisted sketch of a target's keys, so that a batch of new keys need not read the target.

A key's hash is a place in a long row of bits, cut into slots; the sketch keeps, for every load, the
bits of its keys in the slots they fall into. A key whose bit is not set anywhere is new for
certain. Only rows that may be known meet the exact anti join, and if there are none, the target is
not read at all. A sketch that knows too much costs time, never rows: every load has to add its keys
before, or together with, its rows.

With b bits per key about one new key in b is taken for a known one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import files
from starmart.functions import hash_key
from starmart.operators.joins import anti_new
from starmart.operators.skew import complete
from starmart.session import work_dir
from starmart.sinks.parquet import write_observed

# Bits in a slot, fixed by Spark's bitmap functions.
SLOT_BITS = 8 * 4096
BITS_PER_KEY = 16
EXPECTED_KEYS = 100_000_000
SKETCH = "slot bigint, bits binary"


def sketch_slots(spark: SparkSession, path: str) -> int:
    """The number of slots that a sketch was made with; 0 if there is none."""
    return max((int(n.split("=")[1]) for n in files.names(spark, path) if n.startswith("slots=")), default=0)


def _place(keys: Sequence[str], slots: int) -> Column:
    """The key's place among all bits."""
    return F.pmod(hash_key(keys), F.lit(slots * SLOT_BITS))


def sketch_keys(df: DataFrame, keys: Sequence[str], slots: int) -> DataFrame:
    """``slot`` and ``bits`` of the keys of ``df``; rows with a null in their key are left out.

    Bits are set where the rows are and joined by slot: a shuffle of 4 KB per slot and task at most.
    """
    place = _place(keys, slots)
    placed = df.filter(complete(keys)).select(
        F.floor(place / SLOT_BITS).cast("bigint").alias("slot"), (place % SLOT_BITS).cast("bigint").alias("bit")
    )
    return placed.groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("bits"))


def add_keys(df: DataFrame, path: str, keys: Sequence[str], expected_keys: int = EXPECTED_KEYS) -> None:
    """Add the keys of ``df`` to the sketch at ``path``, which the first call makes.

    Its size is fixed then: ``BITS_PER_KEY`` for each of the ``expected_keys``. More keys than that only
    make more of the new ones look known.
    """
    slots = sketch_slots(df.sparkSession, path) or max(1, -(-expected_keys * BITS_PER_KEY // SLOT_BITS))
    sketch_keys(df, keys, slots).write.mode("append").parquet(f"{path}/slots={slots}")


def read_sketch(spark: SparkSession, path: str) -> DataFrame:
    """``slot`` and ``bits``, one row per slot; none if there is no sketch yet."""
    slots = sketch_slots(spark, path)
    if not slots:
        return spark.createDataFrame([], SKETCH)
    loads = spark.read.schema(SKETCH).parquet(f"{path}/slots={slots}")
    return loads.groupBy("slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def compact(spark: SparkSession, path: str) -> None:
    """Write the sketch's loads as one, without changing what it knows. One writer at a time."""
    aside = f"{path.rstrip('/')}/_compact"
    files.remove(spark, aside)
    read_sketch(spark, path).write.parquet(aside)
    inside = f"{path}/slots={sketch_slots(spark, path)}"
    old = list(files.files_below(spark, inside))
    files.move_into(spark, aside, inside)
    for name in old:
        files.remove(spark, f"{inside}/{name}")
    files.remove(spark, aside)


def mark_known(df: DataFrame, sketch: DataFrame, keys: Sequence[str], slots: int, name: str) -> DataFrame:
    """``df`` with a column that is false for rows whose key is new for certain."""
    place = _place(keys, slots)
    rows = df.withColumns({"__slot": F.floor(place / SLOT_BITS).cast("bigint"), "__bit": (place % SLOT_BITS).cast("int")})
    known = sketch.select(F.col("slot").alias("__slot"), F.col("bits").alias("__bits"))
    # The bit's byte, as a number; bits count from the lowest of each byte.
    byte = F.conv(F.hex(F.substring("__bits", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << n) for n in range(8)]), F.col("__bit") % 8 + 1)
    is_set = F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))
    return rows.join(known, "__slot", "left").withColumn(name, is_set).select(*df.columns, name)


def filtered_anti_new(
    df: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    sketch: str,
    prune_by: Sequence[str] = (),
    scratch: str | None = None,
) -> DataFrame:
    """The rows that ``anti_new`` gives, for a target whose keys are in the sketch at path ``sketch``.

    The batch is written once below ``scratch`` (by default the shared folder) with its mark. Rows new for
    certain are not compared with the target. Rows with a null in their key are compared exactly.
    """
    spark, keys = df.sparkSession, list(key)
    slots = max(1, sketch_slots(spark, sketch))
    marked = mark_known(df, read_sketch(spark, sketch), keys, slots, "__known")
    marked = marked.withColumn("__known", F.col("__known") | ~complete(keys))
    path = scratch or work_dir(spark, "marked-batch")
    done = write_observed(marked, path, metrics=[F.count_if("__known").alias("known")])
    rows = spark.read.schema(marked.schema).parquet(path)
    fresh = rows.filter(~F.col("__known")).drop("__known")
    if not done["known"]:
        return fresh
    return fresh.unionByName(anti_new(rows.filter("__known").drop("__known"), target, keys, prune_by))
