"""Conversation repair against every edit script of short conversations and a shortest path for longer ones."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import duckdb
import pytest

from starmart.llm import repair
from starmart.llm.queries import LLM_QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ALLOWED = re.compile(r"(s?(ua)+)?")
INSERTS = [()] + [p for n in (1, 2) for p in product("ua", repeat=n)]


def every_script(rows):
    """The least (cost, audit) over all edit scripts with up to two insertions at a place."""
    choices = []
    for initial, kind in rows:
        own = [("D", None, 3)]
        if kind < 2:
            own += [("K", initial, kind)] + [("R", x, 2 + kind) for x in "ua"]
        choices.append([(i, edit) for i in INSERTS for edit in own])
    found = []
    for script in product(*choices):
        for last in INSERTS:
            roles, audit, cost = "", "", 2 * len(last)
            for inserted, (edit, role, price) in script:
                roles += "".join(inserted) + (role or "")
                audit += "I" * len(inserted) + edit
                cost += 2 * len(inserted) + price
            if ALLOWED.fullmatch(roles + "".join(last)):
                found.append((cost, audit + "I" * len(last)))
    return min(found)


def shortest(rows):
    """The same by a shortest path, with the roles so far cut to what matters: nothing, s, u or a last."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        seen.add((i, last))
        fits = {"": "sua", "s": "u", "u": "a", "a": "u"}[last].replace("a", "a" if last == "u" else "")
        for x in fits:
            if x != "s":
                heapq.heappush(heap, (cost + 2, audit + "I", i, x))
        if i < len(rows):
            initial, kind = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if kind < 2:
                for x in fits:
                    if x == initial:
                        heapq.heappush(heap, (cost + kind, audit + "K", i + 1, x))
                    elif x != "s":
                        heapq.heappush(heap, (cost + 2 + kind, audit + "R", i + 1, x))
    raise AssertionError


def code(row):
    return chr(ord("a") + "suax".index(row[0]) * 3 + row[1])


def parse(rows, block=repair.BLOCK):
    codes = "".join(map(code, rows))
    parts = [repair.block_cells(codes[i : i + block]) for i in range(0, len(codes), block)]
    return repair.best(repair.joined_cells(*map(list, zip(*parts)))[0])


def test_every_short_conversation():
    kinds = list(product("suax", range(3)))
    for n in (1, 2):
        for rows in product(kinds, repeat=n):
            assert parse(rows) == every_script(rows) == shortest(rows), rows
    draw = random.Random(1)
    for _ in range(12):
        rows = [draw.choice(kinds) for _ in range(3)]
        assert parse(rows) == every_script(rows) == shortest(rows), rows


@pytest.mark.parametrize("block", [1, 3, 16])
def test_longer_conversations_in_blocks(block):
    draw = random.Random(block)
    for _ in range(60):
        rows = [(draw.choice("ssuuuaaax"), draw.choice((0, 0, 0, 1, 2))) for _ in range(draw.randint(1, 40))]
        assert parse(rows, block) == shortest(rows), rows


def brute(given):
    """The contract in plain Python, for rows (conv_id, turn, role, text) after damage."""
    rows = sorted(given, key=lambda r: (r[1] is not None, r[1] or 0))
    faults, seen, codes = [], set(), []
    for _, _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        codes.append((initial, {None: 0, "truncated": 1}.get(fault, 2)))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = shortest(codes) if rows else (0, "")
    lines, left, at = [], list(rows), 0
    initials = ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else left.pop(0)[2:]
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if initials[-1:] == "u" else "user"
            text = "" if edit == "I" else text
        initials += role[0]
        lines.append(f"{role}:{text}")
    assert ALLOWED.fullmatch(initials) and not left, at
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        conv, at, role, text = (" " if x is None else x for x in (conv_id, turn, role, text))
        kind = zlib.crc32(f"{conv}:{at}".encode()) % 20
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        out += [(conv_id, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain(rows):
    groups = defaultdict(list)
    for r in damage(rows):
        groups[r[0]].append(r)
    return {c: brute(groups[c]) for c in {r[0] for r in rows}}


def answers(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    found = {r["conv_id"]: tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf}/conversations.parquet'").fetchall()
    assert answers(LLM_QUERIES["op13_repair"](spark, sf)) == plain(rows)


def test_odd_rows_and_one_long_conversation(spark, monkeypatch):
    draw = random.Random(3)
    rows = [
        (None, 1, "user", "no conversation."), (None, 2, None, "no role."), (1, None, "user", "no turn."),
        (1, 5, "user", None), (2, None, None, None), (3, 1, "", "empty role!"), (3, 2, "tool", "漢字。"),
        (4, 7, "system", "only the system?"), (5, 1, "user", "same."), (5, 1, "user", "same."), (5, 1, "user", "same."),
        (6, 1, "user", "long word " * 50_000 + "."), (6, 4, "assistant", "\x0b\x0c \r\n"),
    ]
    texts = ["fine.", "", "cut", "why?", " "]
    rows += [(9, t, draw.choice(["user", "assistant", "system"]), f"{draw.choice(texts)}") for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.selectExpr("*", *[f"'x' AS {c}" for c in "number pos code of start audit fault first kind tie block n".split()])
    assert answers(repair.repair(repair.damaged(clash), clash)) == plain(rows)
    none = df.limit(0)
    assert repair.repair(repair.damaged(none), none).count() == 0
