"""Kept histories: sightings arrive in any order, and the intervals of the keys they touch are made anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import hash_key
from starmart.operators.history import intervals
from starmart.operators.skew import complete
from starmart.schemas import TableSpec
from starmart.sinks.loads import LoadResult, load_new
from starmart.sinks.parquet import write_parquet

PART = "part"
PARTS = 64


def update_history(
    batch: DataFrame, base: str, keys: Sequence[str], ts: str, take: Sequence[str], parts: int = PARTS
) -> LoadResult:
    """Add the sightings of ``batch`` to those below ``base`` and renew the intervals of their keys.

    Keys are dealt to ``parts`` folders by hash. New sightings (distinct rows; a repeated batch adds none)
    are appended, and the intervals of the folders they fall into replace those of before. The result
    depends on the rows only, not on their order or how they are cut into batches. ``parts`` must stay as
    it is; more parts mean less to renew for a small batch.
    """
    spark = batch.sparkSession
    columns = [*keys, ts, *take]
    part = F.pmod(hash_key(keys), F.lit(parts)).cast("int")
    rows = batch.filter(complete([*keys, ts])).select(*columns).withColumn(PART, part)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
    spec = TableSpec("sightings", schema, (), (PART,), (*keys, ts))
    loaded = load_new(rows, f"{base}/sightings", spec, [*columns, PART], (PART,), nulls="equal", dedup_batch=True)
    if loaded.inserted:
        # At most ``parts`` numbers.
        touched = [r[PART] for r in rows.select(PART).distinct().collect()]
        seen = spark.read.schema(schema).parquet(f"{base}/sightings").filter(F.col(PART).isin(touched))
        renewed = intervals(seen, keys, ts, take).withColumn(PART, part)
        write_parquet(renewed, f"{base}/intervals", (PART,), "overwrite", (*keys, "valid_from"), dynamic=True)
    return loaded


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """The intervals: keys, taken columns, ``valid_from`` and ``valid_to``."""
    return spark.read.parquet(f"{base}/intervals").drop(PART)
