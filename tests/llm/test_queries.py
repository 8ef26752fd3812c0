"""Registered text queries against their SQL, and against plain Python where SQL has no words."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import connect, difference
from starmart.llm import fertility, toxicity
from starmart.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_sql(spark, con, name):
    assert difference(LLM_QUERIES[name](spark, SF), con, LLM_ORACLES[name]) is None


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} >= {k.split("_")[0] for k in LLM_QUERIES}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.fixture(scope="module")
def labelled(con):
    return con.execute("SELECT doc_id, quality, toxic FROM labels").fetchall()


def test_op2_base(spark, con):
    got = LLM_QUERIES["op2_fertility"](spark, SF).collect()
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    assert len(got) == len(texts)
    for r in got:
        words = texts[r["doc_id"]].replace("\x0b", " ").encode().split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = {w for w in set(windows) if windows.count(w) > 1} if len(set(windows)) < len(windows) else set()
        covered = {i + k for i, w in enumerate(windows) if w in many for k in range(3)}
        lines = [x for x in texts[r["doc_id"]].split("\n") if x.strip(" \t\r\x0b\x0c")]
        assert r["n_words"] == len(words) and r["n_repeat_words"] == len(covered)
        assert r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_symbols"] == sum(texts[r["doc_id"]].count(c) for c in "#*$%&|<>")
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_op2_verdict(spark):
    """``kept`` from the library's tokens and quartiles of each language in plain Python."""
    import public_tokenizers
    import sentencepiece

    sf = "/root/testdata/sf0.01"
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    by_bytes = fertility.vocabulary(fertility.byte_ranks())
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r for r in LLM_QUERIES["op2_fertility"](spark, sf).collect()}
    measured, passed = {}, defaultdict(list)
    for doc_id, text, lang in docs:
        ids = sp.encode(text)
        blocks = [ids[i : i + 256] for i in range(0, max(1, len(ids) // 256) * 256, 256)]
        blocks[-1] = ids[(len(blocks) - 1) * 256 :]
        bits = sum(-c * math.log2(c / len(b)) for b in blocks for c in Counter(b).values())
        words = text.replace("\x0b", " ").encode().split()
        assert max(map(len, words), default=0) <= fertility.LONGEST
        line = b" ".join(dict.fromkeys(words)).decode()
        again = by_bytes.tokens.encode_ordinary(line)
        measured[doc_id] = {
            "chars_per_token": len(text) / max(1, len(ids)),
            "byte_share": sum(sp.is_byte(i) for i in ids) / max(1, len(ids)),
            "entropy": bits / max(1, len(ids)),
            "chars_per_byte_token": len(line) / max(1, len(again)),
            "partial_share": sum(bool(by_bytes.partial[i]) for i in again) / max(1, len(again)),
            "n": len(ids),
        }
        if not got[doc_id]["base_failed"]:
            passed[lang].append(doc_id)
    rounded = lambda x: float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    rejected = 0
    for doc_id, _, lang in docs:
        inside = True
        for b in fertility.BANDS if len(passed[lang]) >= 50 else ():
            q1, q2, q3 = np.percentile([rounded(measured[i][b.measure]) for i in passed[lang]], [25, 50, 75])
            slack = max((q3 - q1) * b.reach, q2 * b.least, b.floor) * (1 + 100 / max(1, measured[doc_id]["n"]))
            value = measured[doc_id][b.measure]
            inside &= (not b.low or value >= q1 - slack - 1e-9) and (not b.high or value <= q3 + slack + 1e-9)
        assert all(len(passed[x]) >= 50 for x in passed)
        assert got[doc_id]["kept"] == (inside and not got[doc_id]["base_failed"]), doc_id
        rejected += not inside
    assert 0 < rejected < len(docs) / 5


def test_op3_is_the_library(spark, con):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in LLM_QUERIES["op3_pieces"](spark, SF).collect()}
    for doc_id, text in con.execute("SELECT doc_id, text FROM documents").fetchall():
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert got[doc_id]["n_tokens"] == len(ids) and got[doc_id]["spans_tile_text"]
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_op9_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    got = [r for r in LLM_QUERIES["op9_quality"](spark, sf).collect() if r["doc_id"] in labels and r["held_out"]]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in got)
    assert len(got) > 50 and right / len(got) > 0.95


def test_op7_held_out(spark):
    """Trained without a third of the labels, judged on that third."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    apart = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    chain = toxicity.train(docs, labels.filter(~apart))
    judged = toxicity.classify(docs, chain).join(labels.filter(apart).select("doc_id", F.col("toxic").alias("mark")), "doc_id")
    rows = judged.select("mark", "toxic").collect()
    caught, spared = [r["toxic"] for r in rows if r["mark"] == 1], [not r["toxic"] for r in rows if r["mark"] == 0]
    assert len(caught) > 30 and sum(caught) / len(caught) > 0.8 and sum(spared) / len(spared) > 0.98


def test_op7_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    got = [r for r in LLM_QUERIES["op7_toxicity"](spark, sf).collect() if r["doc_id"] in labels]
    caught = [r["toxic"] for r in got if labels[r["doc_id"]] == 1]
    spared = [not r["toxic"] for r in got if labels[r["doc_id"]] == 0]
    assert sum(caught) / len(caught) > 0.95 and sum(spared) / len(spared) > 0.99
