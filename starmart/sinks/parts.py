"""Dimensions in parts: an upsert rewrites the parts its keys fall into, not the table.

Keys are dealt to a fixed number of parts by hash, each a partition of a catalog table with a folder of
its own. An upsert writes a new version of the touched parts, audits it, and then points their
partitions at it, one catalog call a part. Readers see each part before or after, never without its
rows; old folders stay for whoever still reads them. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import files
from starmart.functions import hash_key
from starmart.operators.clean import conform
from starmart.operators.dedup import merge_latest
from starmart.operators.quality import QualityError
from starmart.schemas import TableSpec
from starmart.sinks.audit import Audit
from starmart.sinks.parquet import write_observed

PART = "key_part"
PARTS = 64


def ensure_parted(spark: SparkSession, spec: TableSpec, base: str, name: str | None = None) -> None:
    """Create the table of ``spec`` with a partition column for its parts, unless it exists."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name or spec.name} ({spec.ddl}, `{PART}` int) USING parquet "
        f"PARTITIONED BY ({PART}) LOCATION '{base}'"
    )


def _part(keys: Sequence[str], parts: int):
    return F.pmod(hash_key(keys), F.lit(parts)).cast("int")


def upsert_parts(
    df: DataFrame, spec: TableSpec, base: str, order_by: str | None = None, name: str | None = None,
    parts: int = PARTS, audit: Audit | None = None,
) -> int:
    """Insert new keys and replace the rows of known ones (see ``merge_latest``); returns the parts rewritten.

    Of the table only the touched parts are read. ``parts`` must stay what it was at the first upsert: some
    hundred megabytes a part are a good size. An empty batch changes nothing.
    """
    spark, table = df.sparkSession, name or spec.name
    batch = df.withColumn(PART, _part(spec.pk, parts))
    # At most ``parts`` numbers.
    touched = sorted(r[PART] for r in batch.select(PART).distinct().collect())
    if not touched:
        return 0
    current = spark.table(table).filter(F.col(PART).isin(touched)).drop(PART)
    merged = conform(merge_latest(current, df, spec.pk, order_by), spec).withColumn(PART, _part(spec.pk, parts))
    version = f"{base.rstrip('/')}/version-{uuid.uuid4().hex}"
    checks = audit.metrics(spec) if audit else []
    done = write_observed(merged, version, (PART,), "errorifexists", metrics=checks)
    if audit:
        schema = T.StructType([*spec.schema, T.StructField(PART, T.IntegerType())])
        try:
            audit.check(spec, spark.read.schema(schema).parquet(version), done)
        except QualityError:
            files.remove(spark, version)
            raise
    for part in touched:
        folder = f"{version}/{PART}={part}"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({PART}={part}) LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} PARTITION ({PART}={part}) SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    return len(touched)


def read_parted(spark: SparkSession, spec: TableSpec, name: str | None = None) -> DataFrame:
    """The table without its part column."""
    return spark.table(name or spec.name).select(*spec.columns)
