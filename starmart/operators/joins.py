"""Enrichment by a left join, and the "not yet in the target" anti join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.operators.dedup import dedup_by_key
from starmart.operators.skew import complete, hot_keys, salt_left, salt_right

FANOUT = ("keep", "first", "error")
NULL_RULES = ("not in", "equal")


def _one_match(dim: DataFrame, keys: Sequence[str], fanout: str) -> DataFrame:
    if fanout == "keep":
        return dim
    if fanout == "first":
        return dedup_by_key(dim, keys)
    # A duplicate is found while the dimension is combined per key; no extra job.
    rest = [c for c in dim.columns if c not in keys]
    grouped = dim.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest]
    )
    message = F.concat_ws(" ", F.lit("enrich: several dimension rows for"), *[F.col(k).cast("string") for k in keys])
    return grouped.filter(F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)).drop("__n")


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    fanout: str = "keep",
    round_to: Mapping[str, int] | None = None,
    salts: int = 0,
    hot_share: float = 0.001,
) -> DataFrame:
    """Left outer equi-join: all fact rows, plus ``take`` from the dimension or nulls.

    ``on`` is fact column -> dimension column. A null key matches nothing. When a key occurs more
    than once in the dimension, ``fanout`` keeps all matches, the first by the taken columns, or
    fails. ``round_to`` compares the named fact keys as decimals of that scale (half up).

    Spark broadcasts the dimension only below ``autoBroadcastJoinThreshold`` and else shuffles both
    sides by key, where AQE splits hot fact partitions. ``salts > 1`` also spreads the keys that
    hold more than ``hot_share`` of the fact rows (one more pass over the key columns).
    """
    if fanout not in FANOUT:
        raise ValueError(f"fanout is one of {FANOUT}, not {fanout!r}")
    rounding = dict(round_to or {})
    dim_cols, fact_keys = [], {}
    for i, (left, right) in enumerate(on.items()):
        lhs, rhs = F.col(left), F.col(right)
        if left in rounding:
            exact = f"decimal(18,{rounding[left]})"
            lhs, rhs = lhs.cast(exact), rhs.cast(exact)
        fact_keys[f"__k{i}"] = lhs
        dim_cols.append(rhs.alias(f"__k{i}"))
    keys = list(fact_keys)
    side = dim.select(*dim_cols, *[F.col(c).alias(f"__t_{c}") for c in take]).filter(complete(keys))
    side = _one_match(side, keys, fanout)
    left_side = fact.withColumns(fact_keys)
    join_keys = keys
    if salts > 1:
        hot = hot_keys(left_side, keys, hot_share)
        left_side = salt_left(left_side, hot, keys, salts)
        side = salt_right(side, hot, keys, salts)
        join_keys = [*keys, "__salt"]
    kept = [F.col(c) for c in fact.columns if c not in take]
    return left_side.join(side, join_keys, "left").select(
        *kept, *[F.col(f"__t_{c}").alias(c) for c in take]
    )


def span_metrics(columns: Sequence[str], keys: Sequence[str] = ()) -> list[Column]:
    """Aggregates, as text, that give the span of ``columns`` over the rows whose ``keys`` are complete."""
    inside = complete(keys) if keys else F.lit(True)
    every = F.when(inside, F.struct(*columns))
    ends = {}
    for c in columns:
        for end, find in (("min", F.min), ("max", F.max)):
            ends[f"{end} {c}"] = find(F.when(inside, F.col(c)))
        for end, find in (("first", F.min), ("last", F.max)):
            ends[f"{end} {c}"] = find(every)[c]
    return [found.cast("string").alias(name) for name, found in ends.items()]


def _near(target: DataFrame, schema: StructType, ends: Mapping[str, str | None], columns: Sequence[str]) -> DataFrame:
    """Target rows within a span, as literal bounds that reach the file scan.

    Rows with a null in ``columns`` are outside every span.
    """
    if ends[f"min {columns[0]}"] is None:
        return target.filter(F.lit(False))

    def bound(end: str, c: str):
        return F.lit(ends[f"{end} {c}"]).cast(schema[c].dataType).alias(c)

    near = target
    for c in columns:
        near = near.filter(F.col(c).between(bound("min", c), bound("max", c)))
    # December to January: each month lies in the span, but only two (year, month) pairs do.
    for n in range(2, len(columns) + 1):
        lead = columns[:n]
        first, last = (F.struct(*[bound(end, c) for c in lead]) for end in ("first", "last"))
        near = near.filter(F.struct(*lead).between(first, last))
    return near


def anti_new(
    df: DataFrame,
    target: DataFrame,
    key: str | Sequence[str],
    prune_by: Sequence[str] = (),
    nulls: str = "not in",
    unique_target: bool = False,
    span: Mapping[str, str | None] | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``target``.

    ``nulls="not in"`` has the null rules of ``NOT IN``: an empty target keeps every row, a non-empty
    one drops rows with a null in their key, since the comparison is unknown for them. With
    ``nulls="equal"`` nulls are values like any other: such a row is new unless the target holds one
    with nulls in the same places. It is an equi-join as well.

    The target's keys are made distinct before they are shuffled, so that a key repeated there costs
    one row per task; ``unique_target`` skips this where the key is the target's primary key.

    Written as a left anti join rather than ``NOT IN``, which Spark can only run by broadcasting
    the whole target. ``prune_by`` names columns that are part of the key or functions of it: of the
    target only the range between the batch's lowest and highest values is read, by skipping
    folders (partition columns) or row groups (other columns, if the files are sorted by them).
    Finding that range is a small job of its own over those columns of the batch, unless it is given as
    ``span``: the values of ``span_metrics``, observed when the batch was written.
    """
    if nulls not in NULL_RULES:
        raise ValueError(f"nulls is one of {NULL_RULES}, not {nulls!r}")
    keys = [key] if isinstance(key, str) else list(key)
    wanted = target
    if prune_by:
        if span is None:
            span = df.agg(*span_metrics(prune_by, keys if nulls == "not in" else ())).first().asDict()
        wanted = _near(target, df.schema, span, prune_by)
        if nulls == "equal":
            wanted = wanted.unionByName(target.filter(~complete(prune_by)))
    if nulls == "equal":
        # Nulls within a struct are equal; as one column the keys lie after ``distinct`` where the join wants them.
        known = wanted.select(F.struct(*keys).alias("__known_key"))
        if not unique_target:
            known = known.distinct()
        return df.join(known, F.struct(*keys) == F.col("__known_key"), "left_anti")
    known = wanted.select(*keys) if unique_target else wanted.select(*keys).distinct()
    fresh = df.join(known, keys, "left_anti").select(*df.columns)
    return fresh.filter(complete(keys) | ~target.exists())
