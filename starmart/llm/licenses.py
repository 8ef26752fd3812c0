"""Licence scans: ordered signature rules over words.

A text becomes its lower-case words with single spaces. Keywords decide which rules are tried at all;
each match becomes an interval of words; an interval inside another of the same or a higher priority
is suppressed. Matching runs within the row; intervals, a few numbers each, are placed and compared
by windows per document, so neither step grows with the square of the matches.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import spaces, stored
from starmart.llm.license_rules import CONFIDENCE, Signature, signatures

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_line(text: Column) -> Column:
    """`` w0 w1 ... `` in lower case, or one space if there are no words."""
    framed = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.regexp_replace(framed, NOT_WORD, " ")


def _root(rule: Signature, keywords: set[str]) -> str:
    """A string that every match of the rule contains, shared by many rules."""
    must, before = rule.pattern, None
    while must != before:
        must, before = re.sub(r"\(\?:[^()]*\)\??", " ", must), must
    if "licen" in must:
        return "licen"
    return min((k for k in keywords if k in rule.keyword), key=lambda k: (len(k), k))


def _hits(line: Column, rules: tuple[Signature, ...]) -> Column:
    """Per rule with matches: its number, and in words the gap before and the length of each match.

    Rules hang below their keyword and keywords below a root, so a text is searched for some twenty
    strings, and for more only where one of these is found.
    """
    keywords = {r.keyword for r in rules}
    tree: dict[str, dict[str, list[Column]]] = {}
    for n, r in enumerate(rules):
        pattern = F.lit(f"(?<= )(?:{r.pattern})(?= )")
        rule = F.struct(F.lit(n).alias("rule"), pattern.alias("pattern"))
        tree.setdefault(_root(r, keywords), {}).setdefault(r.keyword, []).append(rule)

    def node(text: str, below: list[Column]) -> Column:
        return F.struct(F.lit(text).alias("text"), F.array(*below).alias("below"))

    tried = F.array(*[node(root, [node(k, own) for k, own in x.items()]) for root, x in tree.items()])
    for _ in range(2):
        present = F.filter(tried, lambda x: F.contains(line, x["text"]))
        tried = F.flatten(F.transform(present, lambda x: x["below"]))
    found = F.transform(
        tried,
        lambda r: F.struct(
            r["rule"].alias("rule"),
            F.transform(F.split(line, r["pattern"], -1), spaces).alias("gaps"),
            F.transform(F.regexp_extract_all(line, r["pattern"], F.lit(0)), spaces).alias("matches"),
        ),
    )
    return F.filter(found, lambda h: F.size(h["matches"]) > 0)


def scan_rows(docs: DataFrame, rules: tuple[Signature, ...]) -> DataFrame:
    """``row``, ``doc_id``, ``n_words`` and ``hits`` of each row, written."""
    line = F.col("line")
    lined = docs.select("doc_id", words_line(F.col("text")).alias("line"))
    return stored(
        lined.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            (spaces(line) - 1).cast("bigint").alias("n_words"),
            _hits(line, rules).alias("hits"),
        ),
        "license-hits",
    )


def place(rows: DataFrame, rules: tuple[Signature, ...]) -> DataFrame:
    """One row per match: its rule, first and last word, and whether it is suppressed."""
    per_rule = rows.select("row", "doc_id", "n_words", F.explode("hits").alias("hit"))
    matches = per_rule.select(
        "row",
        "doc_id",
        "n_words",
        F.col("hit.rule").alias("rule"),
        F.col("hit.gaps").alias("gaps"),
        F.posexplode("hit.matches").alias("at", "inner"),
    ).withColumn("gap", F.get("gaps", F.col("at")))
    # Spaces up to a match: those of the gaps up to it and of the matches before it. The text starts
    # with a space, so one less is the number of words before it.
    upto = Window.partitionBy("row", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    first = F.sum(F.col("gap") + F.col("inner")).over(upto) - F.col("inner") - 1
    level = F.get(F.array(*[F.lit(r.level) for r in rules]), F.col("rule"))
    placed = matches.select(
        "row",
        "doc_id",
        "n_words",
        "rule",
        level.alias("level"),
        first.alias("first"),
        (first + F.col("inner")).alias("last"),
    )
    # In this order whatever contains an interval, and goes before it, stands before it.
    before = (
        Window.partitionBy("row")
        .orderBy("first", F.desc("last"), "level", "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.lit(False)
    for n in range(len(CONFIDENCE)):
        reach = F.max(F.when(F.col("level") <= n, F.col("last"))).over(before)
        inside = F.when(F.col("level") == n, F.coalesce(reach >= F.col("last"), F.lit(False))).otherwise(inside)
    return placed.withColumn("suppressed", inside)


def scan(docs: DataFrame, rules: tuple[Signature, ...] | None = None) -> DataFrame:
    """Detected licences, one row per row of ``docs``.

    ``doc_id``, ``n_words``; ``n_base``, ``first_word`` and ``last_word``: number of places of base
    phrases, smallest and largest start (null if none); ``base_labels`` and ``labels``: distinct,
    sorted, comma-joined, of base phrases and of all detections not suppressed together with the base
    ones; ``score``: the confidence of the surest detection, 0 if none; ``n_detections``.
    Null texts count as empty. Repeated rows are scanned alike, other columns ignored. An empty table gives
    no rows. A text of any length is one row of its hits, scanned whole.
    """
    rules = signatures() if rules is None else tuple(rules)
    rows = scan_rows(docs, rules)
    label = F.get(F.array(*[F.lit(r.label) for r in rules]), F.col("rule"))
    sure = F.get(F.array(*[F.lit(c) for c in CONFIDENCE]), F.col("level"))
    base = F.get(F.array(*[F.lit(r.base) for r in rules]), F.col("rule"))
    found = place(rows, rules).select(
        "row", "doc_id", "n_words", "first", label.alias("label"), sure.alias("sure"), base.alias("base"), "suppressed"
    )
    kept = ~F.col("suppressed")

    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    with_hits = found.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.col("base") | kept).alias("labels"),
        F.max(F.when(F.col("base") | kept, F.col("sure"))).alias("score"),
        F.count(F.when(kept, 1)).alias("n_detections"),
    )
    nothing = F.lit(None).cast("bigint")
    without = rows.filter(F.size("hits") == 0).select(
        "row",
        "doc_id",
        "n_words",
        F.lit(0).cast("bigint").alias("n_base"),
        nothing.alias("first_word"),
        nothing.alias("last_word"),
        F.lit("").alias("base_labels"),
        F.lit("").alias("labels"),
        F.lit(0.0).alias("score"),
        F.lit(0).cast("bigint").alias("n_detections"),
    )
    both = with_hits.unionByName(without).drop("row")
    return both.withColumns({c: F.col(c).cast("bigint") for c in ("first_word", "last_word")})


def detections(docs: DataFrame, rules: tuple[Signature, ...] | None = None) -> DataFrame:
    """The detections themselves: ``doc_id``, ``label``, ``level``, ``first``, ``last``, ``suppressed``.

    ``first`` and ``last`` are word numbers from 0.
    """
    rules = signatures() if rules is None else tuple(rules)
    label = F.get(F.array(*[F.lit(r.label) for r in rules]), F.col("rule"))
    return place(scan_rows(docs, rules), rules).select(
        "doc_id", label.alias("label"), "level", "first", "last", "suppressed"
    )
