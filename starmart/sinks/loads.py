"""Incremental loads: only rows whose key is not in the target yet."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import files
from starmart.functions import hash_key
from starmart.operators.clean import conform
from starmart.operators.dedup import dedup_by_key
from starmart.operators.id_ranges import BLOCK_SIZE, add_reserved_id
from starmart.operators.identity import add_id
from starmart.operators.joins import anti_new, span_metrics
from starmart.schemas import TableSpec
from starmart.session import dropping_shuffles, work_dir
from starmart.sinks.audit import Audit, has_rows
from starmart.sinks.parquet import write_observed


class LoadResult(NamedTuple):
    inserted: int
    skipped: int | None = None


def read_target(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The target with its declared types; an absent folder is created empty."""
    spark.createDataFrame([], spec.schema).write.mode("ignore").parquet(
        path, partitionBy=list(spec.partition_by) or None
    )
    return spark.read.schema(spec.schema).parquet(path)


Step = Callable[[DataFrame, DataFrame, str], DataFrame]


def _as_is(rows: DataFrame, target: DataFrame, scratch: str) -> DataFrame:
    return rows


def _load(
    batch: DataFrame, path: str, spec: TableSpec, key: Sequence[str], prune_by: Sequence[str], count_skipped: bool,
    nulls: str, audit: Audit | None, prepare: Step | None = None, finish: Step = _as_is,
) -> LoadResult:
    """Write the new rows aside, in their final layout, and move them into the table if they pass.

    A batch that is pruned by its span, counted or prepared is itself written once before: its span is
    observed by that write. Nothing new leaves no file, and what fails leaves the table as it was. The
    folder aside is a hidden one of the table, so that moving stays within a file system.
    """
    spark = batch.sparkSession
    missing = [f.name for f in spec.schema if f.name in key and f.nullable]
    if nulls == "not in" and missing:
        raise ValueError(f"{spec.name}: {missing} may be null; compare with nulls='equal'")
    target = read_target(spark, path, spec)
    scratch, aside = work_dir(spark, "load"), f"{path.rstrip('/')}/_load-{uuid.uuid4().hex}"
    try:
        with dropping_shuffles(spark):
            total, span = None, None
            if prune_by or count_skipped or prepare:
                wanted = span_metrics(prune_by, key if nulls == "not in" else ()) if prune_by else []
                span = write_observed(batch, f"{scratch}/batch", metrics=wanted)
                total = int(span["n"])
                batch = spark.read.schema(batch.schema).parquet(f"{scratch}/batch")
            if prepare:
                batch = prepare(batch, target, scratch)
            fresh = anti_new(batch, target, key, prune_by, nulls, set(spec.pk) <= set(key), span)
            rows = finish(fresh, target, scratch)
            checks = audit.metrics(spec) if audit else []
            done = write_observed(rows, aside, spec.partition_by, "append", spec.sort_by, metrics=checks)
            inserted = int(done["n"])
            if audit:
                audit.check(spec, spark.read.schema(spec.schema).parquet(aside), done, target)
            if inserted:
                files.move_into(spark, aside, path)
    finally:
        for folder in (scratch, aside):
            files.remove(spark, folder)
    return LoadResult(inserted, total - inserted if count_skipped else None)


def load_new(
    df: DataFrame,
    path: str,
    spec: TableSpec,
    key: Sequence[str] | None = None,
    prune_by: Sequence[str] = (),
    count_skipped: bool = False,
    nulls: str = "not in",
    dedup_batch: bool = False,
    audit: Audit | None = None,
) -> LoadResult:
    """Append the rows whose key (``spec.pk`` by default) the target does not hold.

    A second run of the same batch inserts nothing and leaves no file. ``prune_by`` and ``nulls``: see
    ``anti_new``; a key with columns that may be null needs ``nulls="equal"``. ``count_skipped``
    counts the batch, which is written once for that; ``dedup_batch`` keeps one row per key of it.
    ``audit`` has to hold for the new rows, or the load fails and leaves the target as it was.
    """
    rows, key = conform(df, spec), key or spec.pk
    if dedup_batch:
        rows = dedup_by_key(rows, key, combine=True)
    return _load(rows, path, spec, key, prune_by, count_skipped, nulls, audit)


def load_fact(
    df: DataFrame,
    path: str,
    spec: TableSpec,
    key: Sequence[str],
    id_kind: str = "hash",
    id_start: int | None = None,
    dedup_batch: bool = False,
    prune_by: Sequence[str] = (),
    count_skipped: bool = False,
    nulls: str = "not in",
    audit: Audit | None = None,
    id_salt: Sequence[str] = (),
    id_ledger: str | None = None,
    id_block: int = BLOCK_SIZE,
) -> LoadResult:
    """Append new fact rows by business key and give them their id.

    ``df`` has all columns of ``spec`` but the id. The key is compared with the target only, so
    equal keys inside one batch are all loaded unless ``dedup_batch``. A hash id is taken over
    every column and, from the second on, the number of the copy: identical rows of one batch get
    ids of their own; ``id_salt`` goes into the hash as well. A sequence goes on from the target's
    largest id unless ``id_start`` is given, for one load at a time; ``reserved`` ids come from the blocks of
    ``id_ledger`` (see ``add_reserved_id``), for several loads at once.
    """
    (id_column,) = spec.pk
    columns = [c for c in spec.columns if c != id_column]
    batch = df.select(*columns)
    hashed_by = [*columns, *[F.lit(x) for x in id_salt]]
    if dedup_batch:
        batch = dedup_by_key(batch, key)

    def tell_copies_apart(hashed: DataFrame, target: DataFrame, scratch: str) -> DataFrame:
        """Only rows whose 8-byte hash occurs twice are grouped by all their columns."""
        spark = hashed.sparkSession
        twice = hashed.groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(id_column)
        twice.write.parquet(f"{scratch}/repeated")
        repeated = spark.read.schema(twice.schema).parquet(f"{scratch}/repeated")
        if not has_rows(repeated):
            return hashed
        # No hash is null. Said here, both joins below read and deal the same rows, which Spark then does once.
        hashed, repeated = (df.filter(F.col(id_column).isNotNull()) for df in (hashed, repeated))
        once = hashed.join(repeated, id_column, "left_anti")
        # Copies are counted, which is combined before the shuffle, and written out again.
        counted = hashed.join(repeated, id_column, "left_semi").groupBy(*hashed.columns).agg(F.count(F.lit(1)).alias("__n"))
        copies = counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
        number = F.when(F.col("__copy") > 1, hash_key([*hashed_by, "__copy"])).otherwise(F.col(id_column))
        return once.unionByName(copies.withColumn(id_column, number).select(*hashed.columns))

    def number(fresh: DataFrame, target: DataFrame, scratch: str) -> DataFrame:
        if id_kind == "reserved":
            if not id_ledger:
                raise ValueError("reserved ids need an id_ledger")
            rows = fresh.select(*columns)
            return conform(add_reserved_id(rows, id_ledger, id_column, id_block, f"{scratch}/sequence"), spec)
        start = id_start
        if start is None:
            start = 1
            if id_kind == "sequence":
                # Answered from the files' statistics.
                start = (target.agg(F.max(id_column)).first()[0] or 0) + 1
        return conform(add_id(fresh, id_kind, id_column, columns, start, scratch=f"{scratch}/sequence"), spec)

    steps: dict[str, Step] = {"finish": number}
    if id_kind == "hash":
        batch, steps = conform(batch.withColumn(id_column, hash_key(hashed_by)), spec), {"prepare": tell_copies_apart}
    return _load(batch, path, spec, key, prune_by, count_skipped, nulls, audit, **steps)
