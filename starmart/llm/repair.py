"""Conversation structure repair by weighted interval parsing.

The target language of role initials is ``(s?(ua)+)?``. In Chomsky normal form a nonterminal ``pq``
derives the spans of rows whose edits lead the language's automaton from state p to state q: ``pq -> pr rq``
for two neighbouring spans, ``pq -> edit`` for one row. Rows inserted before, between and after are
closed over once and put around every single-row cell. A cell holds the least (cost, audit); cells are
combined bottom-up by span length.

Two audits of one cell and cost are never a prefix of one another (what is longer by insertions alone
costs more), so the least audit of a span is made of the least audits of its parts, and neighbouring
spans may be combined in any grouping. A long conversation is therefore parsed in blocks, each with a
chart of its own, whose cells are combined level by level: no task needs all rows of a conversation.
Its hash is one of all its text in order, which streams through one task in batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import package_root, small, stored
from starmart.operators import add_id

# Rows of a block, and blocks (of a level) combined at once.
BLOCK = 16
FAN = 64

COST = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED = 1
# States: nothing yet, after the system row, after a user row, after an assistant row.
STATES = range(4)
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

# A row's code: its initial (s, u, a or another), and whether it is sound, truncated or has to go.
INITIALS, KINDS = "suax", 3
Cells = dict[tuple[int, int], tuple[int, str]]


def _least(cells: Cells, at: tuple[int, int], found: tuple[int, str]) -> None:
    if at not in cells or found < cells[at]:
        cells[at] = found


def combined(left: Cells, right: Cells) -> Cells:
    """The cells of a span made of two neighbouring spans: ``pq -> pr rq``."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for (other, q), (more, rest) in right.items():
            if other == r:
                _least(out, (p, q), (cost + more, audit + rest))
    return out


def _insertions() -> Cells:
    """Closure over inserted rows: the cells of a span without rows."""
    cells: Cells = {(p, p): (0, "") for p in STATES}
    for (p, initial), q in MOVES.items():
        if initial in ROLES:
            _least(cells, (p, q), (COST["I"], "I"))
    for _ in STATES:
        for at, found in combined(cells, cells).items():
            _least(cells, at, found)
    return cells


INSERTED = _insertions()


@lru_cache(maxsize=None)
def row_cells(code: str) -> Cells:
    """The cells of one row, with what may be inserted around it."""
    number = ord(code) - ord("a")
    own, kind = INITIALS[number // KINDS], number % KINDS
    cells: Cells = {(p, p): (COST["D"], "D") for p in STATES}
    for (p, initial), q in MOVES.items():
        edit = "K" if initial == own else "R" if initial in ROLES else None
        if edit and kind < 2:
            _least(cells, (p, q), (COST[edit] + TRUNCATED * kind, edit))
    return combined(combined(INSERTED, cells), INSERTED)


@lru_cache(maxsize=1 << 14)
def chart(codes: str) -> Cells:
    """The cells of a whole block: all its spans by length, each from every split into two."""
    n = len(codes)
    spans: dict[tuple[int, int], Cells] = {(i, i + 1): row_cells(codes[i]) for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cells: Cells = {}
            for k in range(i + 1, i + length):
                for at, found in combined(spans[i, k], spans[k, i + length]).items():
                    _least(cells, at, found)
            spans[i, i + length] = cells
    return spans[0, n]


def illegal_pairs(codes: str) -> int:
    """Neighbours whose initials may not follow one another."""
    initials = [INITIALS[(ord(c) - ord("a")) // KINDS] for c in codes]
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _packed(cells: Cells) -> str:
    return " ".join(f"{p}{q}{cost}{audit}" for (p, q), (cost, audit) in cells.items())


def _unpacked(text: str) -> Cells:
    cells: Cells = {}
    for cell in text.split(" "):
        body = cell[2:]
        audit = body.lstrip("0123456789")
        cells[int(cell[0]), int(cell[1])] = (int(body[: len(body) - len(audit)]), audit)
    return cells


def block_cells(codes: str) -> tuple[str, str, int]:
    """Packed cells, the first and the last code, and the illegal pairs of a block."""
    return _packed(chart(codes)), codes[0] + codes[-1], illegal_pairs(codes)


def joined_cells(cells: list[str], ends: list[str], illegal: list[int]) -> tuple[str, str, int]:
    """The same of neighbouring blocks, in rounds over pairs of them."""
    parts = [_unpacked(c) for c in cells]
    while len(parts) > 1:
        paired = [combined(a, b) for a, b in zip(parts[::2], parts[1::2])]
        parts = paired + parts[2 * len(paired) :]
    between = sum(illegal_pairs(a[1] + b[0]) for a, b in zip(ends, ends[1:]))
    return _packed(parts[0]), ends[0][0] + ends[-1][1], sum(map(int, illegal)) + between


def best(cells: str) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    return min(found for (p, q), found in _unpacked(cells).items() if p == 0 and q in ACCEPTED)


def _with_package(root: str) -> None:
    import sys

    if root not in sys.path:
        sys.path.append(root)


PARSED = "cells string, ends string, illegal bigint"


def parsed(coded: DataFrame) -> DataFrame:
    """``conv_id``, ``cost``, ``audit`` and ``illegal`` of each conversation of
    ``coded(conv_id, pos, code)``; ``pos`` counts its rows from 0."""
    root = package_root()

    @F.pandas_udf(PARSED)
    def parse(codes: pd.Series) -> pd.DataFrame:
        _with_package(root)
        from starmart.llm import repair

        return pd.DataFrame([repair.block_cells(c) for c in codes], columns=["cells", "ends", "illegal"])

    @F.pandas_udf(PARSED)
    def join(cells: pd.Series, ends: pd.Series, illegal: pd.Series) -> pd.DataFrame:
        _with_package(root)
        from starmart.llm import repair

        rows = [repair.joined_cells(list(c), list(e), list(i)) for c, e, i in zip(cells, ends, illegal)]
        return pd.DataFrame(rows, columns=["cells", "ends", "illegal"])

    @F.pandas_udf("cost bigint, audit string")
    def choose(cells: pd.Series) -> pd.DataFrame:
        _with_package(root)
        from starmart.llm import repair

        return pd.DataFrame([repair.best(c) for c in cells], columns=["cost", "audit"])

    # At most BLOCK rows, and later FAN blocks, come together in one group.
    in_order = F.sort_array(F.collect_list(F.struct("pos", "code")))
    blocks = coded.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).alias("block")).agg(in_order.alias("rows"))
    codes = F.array_join("rows.code", "")
    level = blocks.select("conv_id", "block", parse(codes).alias("found")).select("conv_id", "block", "found.*")
    level = stored(level, "blocks")
    while not level.filter("block > 0").isEmpty():
        whole = F.sort_array(F.collect_list(F.struct("block", "cells", "ends", "illegal")))
        groups = level.groupBy("conv_id", F.floor(F.col("block") / FAN).alias("block")).agg(whole.alias("rows"))
        found = join("rows.cells", "rows.ends", "rows.illegal").alias("found")
        level = stored(groups.select("conv_id", "block", found).select("conv_id", "block", "found.*"), "blocks")
    return level.select("conv_id", choose("cells").alias("best"), "illegal").select("conv_id", "best.*", "illegal")


def _or_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a hash of ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row, 1 empties
    its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's. Other columns are left out."""
    key = F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _or_space(F.col("role")).alias("role"), _or_space(F.col("text")).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def _outlines(given: DataFrame) -> DataFrame:
    """What the parse needs of each row instead of its text."""
    last = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    return given.select(
        "conv_id", "turn", "role", "tie", F.unhex(F.sha2("text", 256)).alias("digest"),
        (last == "").alias("blank"), F.right(last, F.lit(1)).isin(".", "!", "?").alias("whole"),
    )


def _coded(ordered: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``pos``, ``code`` and the ``fault`` of each numbered row; written."""
    rows = stored(ordered, "numbered-rows")
    starts = rows.groupBy(F.col("conv_id").alias("conv")).agg(F.min("number").alias("start"))
    # Only texts that a conversation repeats are joined.
    seen = rows.groupBy(F.col("conv_id").alias("other"), F.col("role").alias("as"), F.col("digest").alias("same")).agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("n")
    )
    seen = small(stored(seen.filter("n > 1").drop("n"), "repeated-rows"))
    known = F.col("conv_id").eqNullSafe(F.col("other")) & (F.col("role") == F.col("as")) & (F.col("digest") == F.col("same"))
    placed = rows.join(seen, known, "left").join(stored(starts, "starts"), F.col("conv_id").eqNullSafe(F.col("conv")))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("number") > F.col("first"), "duplicate").when(~F.col("whole"), "truncated")
    )
    initial = F.instr(F.lit(INITIALS[:3]), F.substring("role", 1, 1)) - 1
    initial = F.when((F.col("role") == "") | (initial < 0), len(INITIALS) - 1).otherwise(initial)
    kind = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    coded = placed.withColumn("fault", fault).select(
        "conv_id", "turn", (F.col("number") - F.col("start")).alias("pos"), "fault", F.char(F.lit(ord("a")) + initial * KINDS + kind).alias("code")
    )
    return stored(coded, "coded-rows")


class Lines:
    """The hash of one repaired conversation, fed row by row with its edits in mind."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0
        self.digest, self.first = hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _next(self) -> str:
        """The initial that an inserted or renamed row has to have here."""
        return "a" if self.state == 2 else "u"

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            initial = self._next()
            self._line(ROLES[initial], "")
            self.state, self.at = MOVES[self.state, initial], self.at + 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        initial = role[0] if edit == "K" else self._next()
        self._line(role if edit == "K" else ROLES[initial], text)
        self.state = MOVES[self.state, initial]

    def end(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


def hashed_batches(batches: Iterator[pa.RecordBatch], key: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Hashes of conversations whose rows arrive in order, each led by a row with its audit."""
    lines, conv = None, None

    def out(ids, hashes):
        return pa.RecordBatch.from_arrays([pa.array(ids, key), pa.array(hashes, pa.string())], ["conv_id", "repaired_sha256"])

    for batch in batches:
        ids, hashes = [], []
        for conv_id, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
            if audit is None:
                lines.row(role, text)
                continue
            if lines:
                ids.append(conv)
                hashes.append(lines.end())
            lines, conv = Lines(audit), conv_id
        yield out(ids, hashes)
    if lines:
        yield out([conv], [lines.end()])


def _hashes(given: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256``: a conversation's text passes one task in order, in batches.

    The order is that of the numbers, so they need not be joined with the text, which is shuffled once."""
    root = package_root()

    def run(batches):
        _with_package(root)
        from starmart.llm import repair

        first = next(batches, None)
        if first is not None:
            from itertools import chain

            yield from repair.hashed_batches(chain([first], batches), first.schema.field("conv_id").type)

    nothing = F.lit(None).cast("string")
    rows = given.select("conv_id", F.lit(1).alias("rank"), "turn", "role", "tie", nothing.alias("audit"), "text")
    blank = {c: nothing.cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "tie", "text")}
    leads = found.select("conv_id", F.lit(0).alias("rank"), "audit", *blank.values())
    dealt = leads.unionByName(rows).repartition("conv_id")
    sorted_rows = dealt.sortWithinPartitions("conv_id", "rank", "turn", "role", "tie")
    kind = given.schema["conv_id"].dataType.simpleString()
    return sorted_rows.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(conversations: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """One row per ``conv_id`` of ``originals`` (by default of ``conversations`` itself): ``gaps``,
    ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    Rows are taken by turn (nulls first), rows of one turn by role and a hash of their text; a null role or
    text is one space; a null ``conv_id`` is a conversation of its own. A row counts by its first fault:
    blank, duplicate (role and text of an earlier row), truncated. The cheapest edits keep, rename, delete
    or insert rows so that the roles are an optional system row and pairs of user and assistant; blank rows
    and duplicates have to go, a truncated row that stays costs one. Of equal costs the least audit counts.
    A conversation without rows has zeros, an empty audit and the hash of the empty text. An empty table
    gives no rows. Very long texts pass in Arrow batches; other columns are ignored.
    """
    given = conversations.select(
        "conv_id", "turn", _or_space(F.col("role")).alias("role"), _or_space(F.col("text")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    ordered = add_id(_outlines(given), "sequence", "number", start=0, order_by=["conv_id", "turn", "role", "tie"])
    coded = _coded(ordered)
    found = stored(parsed(coded.select("conv_id", "pos", "code")), "parsed")
    counts = coded.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.count_if(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    out = (conversations if originals is None else originals).select("conv_id").distinct()
    for part in (counts, found, _hashes(given, found)):
        part = part.withColumnRenamed("conv_id", "of")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    longs = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
