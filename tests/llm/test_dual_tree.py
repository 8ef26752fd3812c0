"""Ranked search by two trees against scores of every document in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from llm_fixtures import CLASH, ODD, docs, none, odd  # noqa: F401

from starmart.llm import dual_tree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(documents, items, top=20):
    counts = [(i, Counter(terms(t))) for i, t in documents]
    n_docs, total = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counts:
            m = 75 + (25 * c.total() * n_docs) // max(1, total)
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        ranked = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top]
        out += [(item_id, n + 1, d, -s) for n, (s, _, d) in enumerate(ranked)]
    return sorted(out, key=repr)


@pytest.fixture
def asked(spark):
    return lambda made: spark.createDataFrame(made, "item_id bigint, text string")


def made(seed, n, vocabulary=300, words=60):
    draw = random.Random(seed)
    names = [f"t{k}" for k in range(vocabulary)]
    likely = [1 / (k + 1) for k in range(vocabulary)]
    return [(k, " ".join(draw.choices(names, likely, k=draw.randint(1, words)))) for k in range(n)]


@pytest.mark.parametrize(("top", "part", "block"), [(20, 16, 1 << 16), (3, 1, 1 << 16), (5, 16, 120)])
def test_same_as_all_scores(docs, asked, top, part, block):
    documents, items = made(1, 900), made(2, 60, words=20)
    got = dual_tree.rank_documents(docs(documents), asked(items), top, part, block)
    assert rows(got) == brute(documents, items, top)


def test_ties_and_repeats(docs, asked):
    documents = [(9, "same words"), (3, "same words"), (None, "same words"), (3, "same words"), (5, "Same-WORDS!"), (6, "other")]
    items = [(1, "same same"), (1, "same same"), (None, "words"), (2, ""), (3, None), (4, "absent")]
    got = dual_tree.rank_documents(docs(documents), asked(items), top=3)
    assert rows(got) == brute(documents, items, 3)


def test_odd(docs, none, asked):
    items = [(1, "again 漢字 naïve"), (2, "long of many, WORDS"), (3, "🙂")]
    named = asked(items)
    for name in CLASH.split():
        if name != "text":
            named = named.selectExpr("*", f"'x' AS {name}")
    got = dual_tree.rank_documents(docs(ODD, CLASH), named)
    assert rows(got) == brute([r[:2] for r in ODD], items)
    assert dual_tree.rank_documents(none, named).count() == 0
    assert dual_tree.rank_documents(docs(ODD), asked([])).count() == 0


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(dual_tree, "CHUNK", 7)
    text = "Some words, naïve and 漢字漢字漢字 again-and again " * 5
    assert {t.decode(): k for t, k in dual_tree.term_counts(text).items()} == Counter(terms(text))


def test_node_pairs_are_passed_over():
    """Documents and items of four languages: only nodes of one language meet, and few are searched."""
    draw, n = random.Random(5), 6000
    spaces = [np.arange(k * 100, k * 100 + 100) for k in range(4)]
    items = dual_tree.Items([], [], [])
    for i in range(64):
        picked = np.array(sorted(draw.sample(list(spaces[i % 4]), 8)))
        items.ids.append(i)
        items.terms.append(picked)
        items.weights.append(np.array([draw.randint(1, 9) for _ in picked]))
    items.build()
    picked = [np.array(draw.sample(list(spaces[draw.randint(0, 3)]), 6)) for _ in range(n)]
    impacts = [np.array([draw.randint(1, 1000) for _ in p]) for p in picked]
    ptr = np.arange(n + 1) * 6
    tree = dual_tree.DocumentTree(np.arange(n), ptr, np.concatenate(picked), np.concatenate(impacts), dual_tree.Kinds.of(items, 400))
    best = dual_tree.Best.start(64, 5)
    scored = dual_tree.search(items, tree, best)
    for i in range(64):
        dense = np.zeros(400, np.int64)
        dense[items.terms[i]] = items.weights[i]
        scores = np.array([(dense[p] * x).sum() for p, x in zip(picked, impacts)])
        order = np.lexsort((np.arange(n), -scores))[:5]
        assert best.docs[i].tolist() == order.tolist() and best.scores[i].tolist() == scores[order].tolist()
    assert scored < 64 * n / 2
    # A tree of which every parent covers its children.
    for node in items.nodes:
        covered = dict(zip(node["terms"].tolist(), node["max"].tolist()))
        for i in items.order[node["start"] : node["end"]]:
            assert all(covered[t] >= w for t, w in zip(items.terms[i].tolist(), items.weights[i].tolist()))
