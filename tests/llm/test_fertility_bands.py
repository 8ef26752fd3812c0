"""Rare languages in tables that another language dominates."""

from __future__ import annotations

import random

from llm_fixtures import docs  # noqa: F401
from starmart.llm import fertility


def text(draw, letters, n=80):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(3, 8))) for _ in range(n))


def test_bands_do_not_depend_on_other_languages(docs):
    draw, plain = random.Random(1), "the of and water people number which other about many then".split()
    georgian = "".join(map(chr, range(0x10D0, 0x10F1)))
    english = [" ".join(draw.choice(plain) for _ in range(80)) for _ in range(400)]
    rows = [(i, t, "s", "en") for i, t in enumerate(english)]
    rows += [(1000 + i, text(draw, georgian), "s", "ka") for i in range(40)]
    rows += [(1200 + i, text(draw, georgian), "s", "xmf") for i in range(20)]  # too few: held against the script
    rows += [(1300 + i, text(draw, "".join(map(chr, range(0x1200, 0x1240)))), "s", "am") for i in range(5)]  # no band
    rows.append((1400, "\U0001f642" * 3000 + " x" * 60, "s", "en"))
    got = {r["doc_id"]: r for r in fertility.rate(docs(rows)).collect()}
    assert len(got) == len(rows) and got[1400]["rejected"]
    assert not any(r["rejected"] for i, r in got.items() if i != 1400)
    assert got[1000]["script"] == "Georgian" and got[1300]["script"] == "Ethiopic"
