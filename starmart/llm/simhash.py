"""Near-duplicates by SimHash fingerprints and multi-index hashing.

Equal fingerprints are one node from the start. A fingerprint is cut into segments, each with a table
from its value to the fingerprints that have it; small Hamming balls around each segment are looked
up there and complete distances verified. Segments and radii leave no pair out: ``sum(radius + 1)``
over the segments exceeds the allowed distance, so two linked fingerprints are within the radius in
at least one of them.

In a crowded table place the members are not compared pair by pair: fingerprints at most 2r apart are
exactly those that share a point within r of both, so each sends its ball of radius r and those that
meet are linked to the smallest. That is linear, and a point is met by at most as many fingerprints
as its ball has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import keep_rows, package_root, small, stored, text_key
from starmart.llm.components import components

SHINGLE = 4
MAX_BITS = 4
HASH_SEED = 42
# Members of a table place from which on it counts as crowded.
CROWDED = 256
BLOCK = 1 << 16


class Segment(NamedTuple):
    shift: int
    bits: int
    radius: int


SEGMENTS = (Segment(0, 22, 1), Segment(22, 22, 1), Segment(44, 20, 0))


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """The majority of each bit of the hashes of all word shingles, repeats included."""
    import xxhash

    found = text.encode().lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    width = min(words, len(found))
    at = np.cumsum([0, *[len(w) + 1 for w in found]]).tolist()
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(found) - width + 1
    for first in range(0, total, BLOCK):
        last = min(total, first + BLOCK)
        hashes = np.array(
            [digest(line[a : b - 1], HASH_SEED) for a, b in zip(at[first:last], at[first + width : last + width])],
            "<u8",
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["doc_id", "text_key", "fp"]
        )


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_key`` and ``fp`` (64 bits as bigint) of each row; null texts count as empty."""
    root = package_root()

    def run(batches):
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from starmart.llm import simhash

        yield from simhash.fingerprint_batches(batches, words)

    key = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(
        "doc_id", text_key(F.col("text")).alias("text_key"), F.coalesce("text", F.lit("")).alias("text")
    )
    return texts.mapInArrow(run, f"doc_id {key}, text_key bigint, fp bigint")


def ball(bits: int, radius: int) -> list[int]:
    """All patterns of at most ``radius`` bits set among ``bits``, as signed 64-bit numbers."""
    found = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    return [x - (1 << 64) if x >= 1 << 63 else x for x in found]


def _place(number: int, s: Segment, fp: Column) -> Column:
    """The segment's number and value as one bigint."""
    value = F.shiftrightunsigned(fp, s.shift).bitwiseAND(F.lit((1 << s.bits) - 1))
    return value.bitwiseOR(F.lit(number << 40))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def close_pairs(tables: DataFrame, probes: DataFrame, max_bits: int) -> DataFrame:
    """Verified pairs ``a < b`` that meet at a table place."""
    return (
        probes.join(tables, "place")
        .filter((F.col("a") < F.col("b")) & (_distance("a", "b") <= max_bits))
        .select("a", "b")
    )


def meeting_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links that connect exactly the fingerprints connected by distances up to ``max_bits`` (even)."""
    masks = F.array(*[F.lit(m).cast("bigint") for m in ball(64, max_bits // 2)])
    sent = fps.select("fp", F.explode(masks).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), "fp"
    )
    met = sent.groupBy("point").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    smallest = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return smallest.filter("a <> b").distinct()


def links(
    fps: DataFrame,
    max_bits: int = MAX_BITS,
    segments: tuple[Segment, ...] = SEGMENTS,
    crowded: int = CROWDED,
) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints of ``fps(fp)``: every verified pair outside
    crowded places, and inside them links with the same components."""
    if sum(s.radius + 1 for s in segments) <= max_bits or max_bits % 2:
        raise ValueError("the segments can miss pairs, or max_bits is odd")
    places = F.array(*[_place(n, s, F.col("fp")) for n, s in enumerate(segments)])
    tables = fps.select(F.explode(places).alias("place"), F.col("fp").alias("b"))
    masks = [F.lit(m).cast("bigint") for s in segments for m in ball(s.bits, s.radius)]
    own = [n for n, s in enumerate(segments) for _ in ball(s.bits, s.radius)]
    looked_up = F.array(*[_place(n, segments[n], F.col("fp")).bitwiseXOR(m) for n, m in zip(own, masks)])
    probes = fps.select(F.explode(looked_up).alias("place"), F.col("fp").alias("a"))
    counted = tables.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowded)
    busy = stored(counted.select("place"), "crowded")
    if busy.isEmpty():
        return close_pairs(tables, probes, max_bits)
    hint = small(busy)
    quiet = close_pairs(tables.join(hint, "place", "left_anti"), probes, max_bits)
    dense = probes.join(hint, "place", "left_semi").select(F.col("a").alias("fp")).distinct()
    return quiet.unionByName(meeting_links(dense, max_bits))


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE,
    max_bits: int = MAX_BITS,
    segments: tuple[Segment, ...] = SEGMENTS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_key``, ``fingerprint`` (16 hex digits),
    ``component_id`` and ``kept``.

    Words are split at white space with A-Z in lower case; a text with fewer words than a shingle is
    one shingle, one without words has fingerprint zero and is linked like any other. Fingerprints
    that differ in at most ``max_bits`` bits are linked (more than 4 need wider ``segments``); ``component_id`` is the smallest ``doc_id``
    reachable (null ids are passed over, and it is null if all are). The row with that id
    stays, of several the one with the smallest ``text_key``.
    Rows with the same id and the same text are kept alike. Other columns are ignored. An empty table
    gives no rows; the shingles of a long text are hashed in blocks.
    """
    rows = stored(fingerprints(docs, words), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    nodes = stored(rows.groupBy("fp").agg(F.min(first).alias("first")), "distinct-fingerprints")
    found = components(links(nodes.select("fp"), max_bits, segments))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    # Written, so that the join has nothing but shuffles below it and a large component is split.
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("smallest")), "smallest")
    classes = stored(rooted.join(smallest, "root").select("fp", "smallest"), "classes")
    return rows.join(classes, "fp").select(
        "doc_id",
        "text_key",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("smallest.doc_id").alias("component_id"),
        first.eqNullSafe(F.col("smallest")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, all columns kept."""
    return keep_rows(docs, near_duplicates(docs))
