"""Histories: from which moment to which an attribute had a value, and its value at a moment.

A row says what was seen of a key at some time. Rows of any order of arrival give the same history, as
it is made of all of them: a late row can split an interval in two. Every step works on a key's rows of
one ``bucket`` of time (a day by default) and then on what is left of each bucket, so no task has to
order all rows of a key at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.skew import complete

DAY_SECONDS = 86_400


def _bucket(ts: str, seconds: int):
    return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / seconds)


def sightings(df: DataFrame, keys: Sequence[str], ts: str, take: Sequence[str]) -> DataFrame:
    """One row per key and moment: ``keys``, ``ts`` and ``take``; rows without a key or time are left out.

    Of several rows of one moment the lowest by ``take`` (nulls last) counts. Combined before the shuffle.
    """
    rows = df.filter(complete([*keys, ts]))
    order = F.struct(*[p for c in take for p in (F.col(c).isNull(), F.col(c).alias(c))])
    lowest = rows.groupBy(*keys, ts).agg(F.min(order).alias("__low"))
    return lowest.select(*keys, ts, *[F.col(f"__low.{c}") for c in take])


def intervals(
    df: DataFrame, keys: Sequence[str], ts: str, take: Sequence[str], seconds: int = DAY_SECONDS
) -> DataFrame:
    """``keys``, ``take``, ``valid_from`` and ``valid_to`` for each span in which ``take`` stays the same.

    An interval begins when the values were first seen after others and ends when others were, exclusive;
    the last one of a key has no end. Within a bucket of ``seconds`` only changes are kept, and of those
    the ones that differ from what the earlier buckets left; so a key has one row a bucket and change to be
    ordered as a whole, however many rows it has.
    """
    rows = sightings(df, keys, ts, take).withColumn("__bucket", _bucket(ts, seconds))
    same = F.struct(*take)

    def changed(frame: DataFrame, *within: str) -> DataFrame:
        order = Window.partitionBy(*keys, *within).orderBy(ts)
        first = F.lag(F.lit(True)).over(order).isNull()
        return frame.withColumn("__new", first | ~F.lag(same).over(order).eqNullSafe(same)).filter("__new")

    found = changed(changed(rows, "__bucket").drop("__new"))
    until = F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts))
    return found.select(*keys, *take, F.col(ts).alias("valid_from"), until.alias("valid_to"))


def as_of(
    fact: DataFrame, seen: DataFrame, keys: Sequence[str], ts: str, take: Sequence[str], seen_ts: str | None = None,
    seconds: int = DAY_SECONDS,
) -> DataFrame:
    """All rows of ``fact`` with ``take`` as last seen of their key at or before their ``ts``, or nulls.

    ``seen`` holds sightings (or the starts of intervals) with ``keys``, ``seen_ts`` (by default ``ts``) and
    ``take``. Both sides are put in order within each key and bucket; what a bucket begins with is carried
    over from the last sighting of an earlier one, found over one row per key and bucket. No row of one
    side is joined with a range of the other, and ``fact`` is shuffled once.
    """
    at = seen_ts or ts
    known = sightings(seen, keys, at, take)
    values = F.struct(*[F.col(c).alias(c) for c in take])
    right = known.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(at).alias("__at"), values.alias("__seen"))
    right = right.withColumn("__bucket", _bucket("__at", seconds))
    payload = F.struct(*[F.col(c).alias(c) for c in fact.columns])
    left = fact.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(ts).alias("__at"), payload.alias("__row"))
    left = left.withColumn("__bucket", _bucket("__at", seconds))
    names = [f"__{k}" for k in keys]
    apart = left.filter(~complete([*names, "__at"]))
    left = left.filter(complete([*names, "__at"]))

    # What each bucket of a key begins with.
    ends = right.groupBy(*names, "__bucket").agg(F.max_by("__seen", "__at").alias("__end"))
    asked = left.select(*names, "__bucket").distinct()
    both = asked.withColumn("__end", F.lit(None).cast(ends.schema["__end"].dataType)).unionByName(ends)
    per_bucket = both.groupBy(*names, "__bucket").agg(F.first("__end", ignorenulls=True).alias("__end"))
    earlier = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(*names, "__bucket", F.last("__end", ignorenulls=True).over(earlier).alias("__begin"))
    carried = carried.filter(F.col("__begin").isNotNull())

    # Sightings come before fact rows of the same moment; a carried value before all of its bucket.
    nothing = F.lit(None)
    kind = right.schema["__seen"].dataType
    events = left.select(*names, "__bucket", "__at", F.lit(2).alias("__kind"), nothing.cast(kind).alias("__seen"), "__row")
    row_kind = left.schema["__row"].dataType
    for frame, rank, value, moment in ((right, 1, "__seen", F.col("__at")), (carried, 0, "__begin", nothing.cast(left.schema["__at"].dataType))):
        events = events.unionByName(
            frame.select(*names, "__bucket", moment.alias("__at"), F.lit(rank).alias("__kind"), F.col(value).alias("__seen"), nothing.cast(row_kind).alias("__row"))
        )
    so_far = (
        Window.partitionBy(*names, "__bucket").orderBy(F.col("__at").asc_nulls_first(), "__kind")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = events.withColumn("__now", F.last("__seen", ignorenulls=True).over(so_far)).filter("__kind = 2")
    # Rows without a key or time have seen nothing; they are not gathered anywhere.
    found = found.select("__row", "__now").unionByName(apart.select("__row", nothing.cast(kind).alias("__now")))
    kept = [c for c in fact.columns if c not in take]
    return found.select(*[F.col(f"__row.{c}").alias(c) for c in kept], *[F.col(f"__now.{c}").alias(c) for c in take])
