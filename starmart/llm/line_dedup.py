"""Removal of lines that stand on many sites.

Each line's sites are gathered in a HyperLogLog sketch per line hash; sketches merge by aggregation,
so tables of sketches of several loads can be united. A line whose estimate is near the threshold
gets an exact count of its sites. All of it is built-in aggregation, combined before each shuffle, so
a line that makes up a third of all lines costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import GAP_CHARS, small, stored, text_key

MIN_SITES = 5
LG_K = 12
# Six standard errors of a sketch with 2^12 registers.
BAND = 0.1
LINE_KEY = ["k1", "k2"]


def site_lines(docs: DataFrame, site_col: str = "source") -> DataFrame:
    """One row per line that is not blank: ``doc_id``, ``text_key``, ``site``, ``pos``, ``k1``, ``k2``.

    The two keys are 128 bits of hash of the line without white space at its ends. A missing site
    counts as the site "". Null and empty texts have no lines.
    """
    lines = docs.select(
        F.col("doc_id"),
        text_key(F.col("text")).alias("text_key"),
        F.coalesce(F.col(site_col), F.lit("")).alias("site"),
        F.posexplode(F.split("text", "\n")).alias("pos", "line"),
    )
    line = F.btrim("line", F.lit(GAP_CHARS))
    return (
        lines.withColumn("line", line)
        .filter(F.col("line") != "")
        .select(
            "doc_id",
            "text_key",
            "site",
            "pos",
            F.xxhash64("line").alias("k1"),
            F.xxhash64(F.lit(1), "line").alias("k2"),
        )
    )


def line_sketches(lines: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """A sketch of the sites of each line: ``k1``, ``k2``, ``sketch``."""
    return lines.groupBy(*LINE_KEY).agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """The union of tables of sketches, e.g. of one load each."""
    both = tables[0]
    for other in tables[1:]:
        both = both.unionByName(other)
    return both.groupBy(*LINE_KEY).agg(F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))


def boilerplate(
    lines: DataFrame,
    sketches: DataFrame | None = None,
    min_sites: int = MIN_SITES,
    band: float = BAND,
) -> DataFrame:
    """Keys of the lines that stand on at least ``min_sites`` sites.

    ``sketches`` must describe ``lines`` (by default it is made from them). Estimates outside the
    band around the threshold are taken as they are; those inside it are counted exactly.
    """
    sketches = line_sketches(lines) if sketches is None else sketches
    spread = sketches.select(*LINE_KEY, F.hll_sketch_estimate("sketch").alias("sites"))
    likely = stored(spread.filter(F.col("sites") >= min_sites * (1 - band)), "line-sites")
    sure = likely.filter(F.col("sites") > min_sites * (1 + band)).select(*LINE_KEY)
    near = small(likely.filter(F.col("sites") <= min_sites * (1 + band)).select(*LINE_KEY))
    exact = (
        lines.join(near, LINE_KEY, "left_semi")
        .select(*LINE_KEY, "site")
        .distinct()
        .groupBy(*LINE_KEY)
        .agg(F.count(F.lit(1)).alias("sites"))
        .filter(F.col("sites") >= min_sites)
        .select(*LINE_KEY)
    )
    return stored(sure.unionByName(exact), "boilerplate")


def remove_boilerplate(
    docs: DataFrame, site_col: str = "source", min_sites: int = MIN_SITES, band: float = BAND
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``.

    Every line standing on ``min_sites`` sites or more goes, wherever it stands; the others and
    blank lines stay in order. Returns ``doc_id``, ``text``, ``n_lines`` (not blank) and
    ``n_removed``, one row per input row. Null texts stay null with no lines; a text that loses all
    lines becomes empty; repeated rows are treated alike; other columns are ignored. An empty table
    gives no rows. A very long text is a row per line between the passes; its lines' numbers come together.
    """
    lines = site_lines(docs, site_col)
    keys = small(boilerplate(lines, None, min_sites, band))
    hits = (
        lines.join(keys, LINE_KEY)
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
        .agg(F.collect_set("pos").alias("__drop"))
    )
    rows = docs.select("doc_id", "text")
    joined = rows.join(
        hits,
        rows["doc_id"].eqNullSafe(F.col("__id")) & (text_key(rows["text"]) == F.col("__key")),
        "left",
    )
    parts = F.split("text", "\n")
    # array_except keeps order and is linear; the lines are picked by what is left of 0..n-1.
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__drop"))
    kept = F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n")
    full = F.filter(parts, lambda x: F.btrim(x, F.lit(GAP_CHARS)) != "")
    return joined.select(
        "doc_id",
        F.when(F.col("__drop").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(full)).cast("bigint").alias("n_lines"),
        F.when(F.col("__drop").isNull(), 0).otherwise(F.size("__drop")).cast("bigint").alias("n_removed"),
    )
