"""Distinct rows, one row per key, and the latest row per key.

One-row-per-key operators rank with ``row_number() = 1``. Spark plans that with a group limit below
the shuffle: every task keeps one row per key it has seen, so a key holding a third of all rows
costs one row per task in the shuffle, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def distinct_rows(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Distinct combinations of ``cols`` (all columns by default), combined before the shuffle."""
    return (df.select(*cols) if cols else df).distinct()


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def _rest(df: DataFrame, used: Iterable[str]) -> list[Column]:
    """The remaining columns as last tie-breakers, so that the kept row is determined."""
    taken = set(used)
    return [F.col(c).asc_nulls_last() for c in df.columns if c not in taken]


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), combine: bool = False
) -> DataFrame:
    """One row per key: the lowest by ``order_by``, then by all other columns (nulls last).

    ``combine=True`` first makes rows distinct with a hash aggregate, so that fewer are sorted: right
    where most rows are repeats. The order covers all columns, so the kept row is the same.
    """
    if combine:
        df = df.distinct()
    order = [F.col(c).asc_nulls_last() for c in order_by] + _rest(df, [*keys, *order_by])
    return _first_per_key(df, keys, order or [F.col(keys[0])])


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    tie_breakers: Sequence[str] = (),
    take: Sequence[str] | None = None,
    combine: bool = False,
) -> DataFrame:
    """The row with the highest ``order_by`` per key (null lowest).

    Ties go to the highest ``tie_breakers``, then to the lowest remaining columns. ``take`` names
    the payload to keep beside the keys. ``combine=True`` first takes the maximum of ``order_by``
    per distinct payload with a hash aggregate: right for slowly changing payloads such as a user's
    name and level, where it leaves a few rows per key to be ranked; useless for unique payloads.
    """
    if take is not None:
        df = df.select(*dict.fromkeys([*keys, order_by, *tie_breakers, *take]))
    if combine:
        payload = [c for c in df.columns if c != order_by]
        df = df.groupBy(*payload).agg(F.max(order_by).alias(order_by))
    order = [F.col(order_by).desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in tie_breakers]
    order += _rest(df, [*keys, order_by, *tie_breakers])
    out = _first_per_key(df, keys, order)
    return out if take is None else out.select(*dict.fromkeys([*keys, *take]))


def latest_by_time_join(
    df: DataFrame, key: str, ts: str, take: Sequence[str], of: DataFrame | None = None
) -> DataFrame:
    """The literal warehouse form of "latest": rows of ``df`` at each key's maximum ``ts``.

    The join is on time alone, so a row of another key at that instant matches as well, and ties
    give several rows per key. ``of`` is the (filtered) frame the maxima are taken from. Use
    ``latest_per_key`` for one row per key.
    """
    last = (df if of is None else of).groupBy(key).agg(F.max(ts).alias("__max_ts"))
    payload = df.select(F.col(ts).alias("__ts"), *[F.col(c).alias(f"__{c}") for c in take])
    return (
        last.filter(F.col(key).isNotNull())
        .join(payload, F.col("__max_ts") == F.col("__ts"))
        .select(key, *[F.col(f"__{c}").alias(c) for c in take])
    )


def merge_latest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: str | None = None
) -> DataFrame:
    """Target and batch as one row per key, the later one winning: the content of an upsert.

    With ``order_by`` in both frames the higher value wins and a late batch cannot undo a newer
    row; on equal values, and when the target does not keep that column, the batch wins. ``batch``
    needs to hold one row per key only if it has no ``order_by``.
    """
    columns = target.columns
    dated = order_by is not None and order_by in columns
    old = target.withColumn("__batch", F.lit(0))
    new = batch.withColumn("__batch", F.lit(1))
    if order_by is not None and not dated:
        old = old.withColumn(order_by, F.lit(None).cast(batch.schema[order_by].dataType))
    both = old.unionByName(new)
    order = [F.col(order_by).desc_nulls_last()] if dated else []
    order.append(F.col("__batch").desc())
    if order_by is not None and not dated:
        order.append(F.col(order_by).desc_nulls_last())
    order += _rest(both, [*keys, "__batch", *([order_by] if order_by else [])])
    return _first_per_key(both, keys, order).select(*columns)
