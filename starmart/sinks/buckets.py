"""Bucketed tables: the target of an anti join stays where its keys are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starmart.operators.clean import conform
from starmart.operators.joins import anti_new
from starmart.schemas import TableSpec


def append_bucketed(df: DataFrame, spec: TableSpec, key: Sequence[str], buckets: int, name: str, folder: str | None = None) -> None:
    """Append to the catalog table ``name``, whose files hold the rows of one bucket of ``key`` each.

    Rows are shuffled by bucket before the write, so that a bucket gets one file a load, not one from every
    task. The first load makes the table, at ``folder`` if given.
    """
    rows = conform(df, spec).repartition(buckets, *key)
    writer = rows.write.format("parquet").mode("append").bucketBy(buckets, *key).sortBy(*key)
    if folder and not df.sparkSession.catalog.tableExists(name):
        writer = writer.option("path", folder)
    writer.saveAsTable(name)


def new_for_bucketed(df: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key the bucketed table ``name`` does not hold (null rules of ``anti_new``).

    Only the batch is shuffled, to the buckets of the table. The table must be bucketed by exactly ``key``,
    whose types are those of the batch; it holds each key once or several times.
    """
    spark: SparkSession = df.sparkSession
    target = spark.table(name)
    keys = list(key)
    types = {f.name: f.dataType for f in target.schema}
    other = [k for k in keys if types[k] != df.schema[k].dataType]
    if other:
        raise ValueError(f"{other} have other types in {name}: rows would have to move to meet")
    return anti_new(df, target, keys, unique_target=True)
