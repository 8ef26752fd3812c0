"""Mixing sources to target weights.

Words are summed per source, targets and repetition rates derived, and each document is emitted
``floor(rate)`` times plus one copy with the probability of the fraction, decided by a hash. The hash
is shifted by one of some steps per source, the one with which the source comes nearest to its target:
documents differ much in length, and a source of few would scatter otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import small, stored, unused, word_count
from starmart.operators import add_id

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 17
SHIFTS = 64
ADDED = ("size", "source_size", "target", "copies")


def repeats() -> Column:
    """Times that a source is repeated, in fractions too; 0 if it has no words."""
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)


def chance(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from a hash of the id (of the text where there is none)."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def shifted(number: Column, shift: Column) -> Column:
    """``number`` in [0, 1) moved on by ``shift`` of ``SHIFTS`` equal steps, around the end."""
    moved = number + shift / F.lit(float(SHIFTS))
    return F.when(moved >= 1, moved - 1).otherwise(moved)


def best_shifts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with the ``shift`` of each source that takes nearest to its target.

    One aggregation over ``sizes(source, size, chance)`` with a sum per step, combined in each task.
    """
    known = targets.withColumnRenamed("source", "__source")
    rated = sizes.join(small(known), sizes["source"].eqNullSafe(F.col("__source"))).withColumn("rate", repeats())
    whole, rest = F.floor("rate"), F.col("rate") - F.floor("rate")
    taken = [
        F.sum(F.col("size") * (whole + (shifted(F.col("chance"), F.lit(k)) < rest).cast("int"))).alias(f"t{k}")
        for k in range(SHIFTS)
    ]
    sums = rated.groupBy("source", "source_size", "target").agg(*taken)
    off = [F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("k")) for k in range(SHIFTS)]
    return sums.select("source", "source_size", "target", F.array_min(F.array(*off))["k"].alias("shift"))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of the sources of ``sizes(source, size)``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes.
    A target stops at ``max_repeats`` times its source's size; what is above is shared again by
    weight. The level at which this settles is found by a few sums over the sources (one row each to
    the driver); the number of sources may grow, none of it is gathered.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = per_source.withColumn("last", F.col("source").isNull())
    ranked = add_id(ordered, "sequence", "rank", start=0, order_by=["last", "source"])
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    sources = stored(
        ranked.select(
            "source",
            "source_size",
            (F.col("source_size") * max_repeats).alias("most"),
            weight.cast("bigint").alias("weight"),
        ),
        "sources",
    )
    level = 0.0
    while True:
        # Sources that the level so far puts above their limit get the limit, the others share the rest.
        above = F.col("most") < F.col("weight") * F.lit(level)
        sums = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, F.col("most")).otherwise(0)).alias("limited"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        new = float(sums["all"] - sums["limited"]) / float(sums["weight"]) if sums["weight"] else 0.0
        if new == level:
            break
        level = new
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", target.alias("target"))


def mixing_plan(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` of each row.

    A null text has size 0; null is a source of its own; a source without words has target 0 and
    none of its rows is taken. Rows with one ``doc_id`` share their chance, so repeated rows are taken
    alike, and reruns agree. Columns of these names in ``docs`` are replaced, others kept whatever their
    names. An empty table gives no rows; long texts are counted where they are and never moved.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ADDED])
    number = chance(F.col("doc_id"), F.col("text"), seed)
    sizes = docs.select("source", word_count(F.col("text")).alias("size"), number.alias("chance"))
    sizes = stored(sizes, "sizes")
    shifts = best_shifts(sizes, source_targets(sizes, weights, max_repeats))
    of, shift, rate = (unused(docs, name) for name in ("__source", "__shift", "__rate"))
    named = shifts.withColumnsRenamed({"source": of, "shift": shift})
    sized = docs.withColumn("size", word_count(F.col("text"))).join(
        small(stored(named, "shifts")), docs["source"].eqNullSafe(F.col(of))
    )
    extra = shifted(number, F.col(shift)) < F.col(rate) - F.floor(rate)
    return (
        sized.withColumn(rate, repeats())
        .withColumn("copies", (F.floor(rate) + extra.cast("int")).cast("int"))
        .drop(of, rate, shift)
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; its columns stay as they are."""
    aside = {c: unused(docs, f"__own_{c}") for c in docs.columns if c in ADDED}
    planned = mixing_plan(docs.withColumnsRenamed(aside), **options).filter("copies > 0")
    copy = unused(planned, "__copy")
    repeated = planned.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
