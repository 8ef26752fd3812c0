"""Catalog tables: create, drop, full refresh and upsert.

Plain Parquet has neither DELETE nor MERGE, and overwriting in place leaves readers an empty table
for a while. A refresh therefore writes a new version folder and then points the table at it, one
catalog call. Old folders stay for whoever still reads them; cleaning up is left to the owner.
One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starmart import files
from starmart.operators.clean import conform
from starmart.operators.dedup import merge_latest
from starmart.operators.quality import QualityError
from starmart.schemas import TableSpec
from starmart.sinks.audit import Audit
from starmart.sinks.loads import LoadResult, load_new
from starmart.sinks.parquet import write_observed


def _version(base: str) -> str:
    return f"{base.rstrip('/')}/version-{uuid.uuid4().hex}"


def ensure_table(spark: SparkSession, spec: TableSpec, base: str, name: str | None = None) -> None:
    """Create an empty external table below ``base`` unless the table exists."""
    parts = f"PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name or spec.name} ({spec.ddl}) USING parquet {parts} "
        f"LOCATION '{_version(base)}'"
    )


def name_folder(
    spark: SparkSession, spec: TableSpec, folder: str, name: str | None = None, extra: str = ""
) -> None:
    """Give the Parquet files of ``folder`` a table's name; ``extra`` is a further text column."""
    table = name or spec.name
    ddl = f"{spec.ddl}, `{extra}` string" if extra else spec.ddl
    parts = f"PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet {parts} LOCATION '{folder}'")
    if spec.partition_by:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def drop_table(spark: SparkSession, name: str | TableSpec) -> None:
    """Drop the table if it exists; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name.name if isinstance(name, TableSpec) else name}")


def table_location(spark: SparkSession, name: str) -> str:
    """The folder a table points at now."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def publish(
    df: DataFrame, spec: TableSpec, base: str, name: str | None = None, audit: Audit | None = None
) -> int:
    """Replace the content of an unpartitioned table by ``df``; returns its rows.

    ``df`` may read the table itself: its current version is not touched. The table is pointed at the
    new version only if that passes the ``audit``.
    """
    if spec.partition_by:
        raise ValueError(f"{spec.name} is partitioned: its folders are registered one by one")
    table = name or spec.name
    folder = _version(base)
    spark = df.sparkSession
    checks = audit.metrics(spec) if audit else []
    done = write_observed(conform(df, spec), folder, mode="errorifexists", metrics=checks)
    if audit:
        try:
            audit.check(spec, spark.read.schema(spec.schema).parquet(folder), done)
        except QualityError:
            files.remove(spark, folder)
            raise
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    return int(done["n"])


def load_dimension(
    df: DataFrame, spec: TableSpec, base: str, append: bool = False, name: str | None = None,
    audit: Audit | None = None,
) -> LoadResult:
    """Full refresh, or with ``append`` only the rows whose key the table does not hold."""
    if not append:
        return LoadResult(publish(df, spec, base, name, audit))
    table = name or spec.name
    spark = df.sparkSession
    loaded = load_new(df, table_location(spark, table), spec, audit=audit)
    spark.catalog.refreshTable(table)
    return loaded


def upsert_dimension(
    df: DataFrame, spec: TableSpec, base: str, order_by: str | None = None, name: str | None = None,
    audit: Audit | None = None,
) -> int:
    """Insert new keys and replace the rows of known ones; see ``merge_latest``."""
    current = df.sparkSession.table(name or spec.name)
    return publish(merge_latest(current, df, spec.pk, order_by), spec, base, name, audit)
