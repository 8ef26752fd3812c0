"""The pipeline against plain Python, each stage on what the one before it gave."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import sentencepiece
from test_native import fill

import corpus_pipeline
from starmart.llm import mixing, simhash, toxicity
from starmart.llm.common import stored, table
from test_python import brute_components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_every_stage(spark):
    docs, given = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect() if name != "toxicity" else table(spark, SF, "documents").collect()
        docs = stored(stage(spark, docs, SF), "stage")
        given[name] = (before, docs.collect(), docs.columns)
    columns = table(spark, SF, "documents").columns
    assert [len(corpus_pipeline.STAGES), list(given)] == [
        5, ["toxicity", "exact_dedup", "near_dedup", "source_mix", "pieces"],
    ]
    assert all(given[n][2] == columns for n in list(given)[:-1])

    before, after, _ = given["toxicity"]
    chain = toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    want = {r["doc_id"] for r in before if chain.score(r["text"])[-1] < 0.5}
    assert Counter(r["doc_id"] for r in after) == Counter(want)

    before, after, _ = given["exact_dedup"]
    first: dict[str, int] = {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(first.values())

    before, after, _ = given["near_dedup"]
    fps = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in before}
    edges = [(a, b) for a, b in combinations(sorted(fps), 2) if (fps[a] ^ fps[b]).bit_count() <= 4]
    assert sorted(r["doc_id"] for r in after) == sorted(set(brute_components(sorted(fps), edges).values()))

    before, after, _ = given["source_mix"]
    sizes = defaultdict(int)
    for r in before:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    target = fill(sizes)
    copies = Counter(r["doc_id"] for r in after)
    for r in before:
        rate = target[r["source"]] / sizes[r["source"]]
        assert int(rate + 1e-9) <= copies[r["doc_id"]] <= min(mixing.MAX_REPEATS, int(rate) + 1)

    before, after, _ = given["pieces"]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((r["doc_id"], tuple(sp.encode(r["text"], add_bos=True, add_eos=True))) for r in before)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in after) == want


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and {"doc_id", "ids", "n_tokens"} <= set(got.columns)
