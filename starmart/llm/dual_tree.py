"""Ranked lexical search by two trees.

Items (the queries) stand in a tree whose nodes hold, per term, the largest weight of any item below;
documents stand in trees, one per batch of rows, whose nodes hold the largest impact of any document
below. The product of two nodes' maxima bounds every score between them. A pair of nodes is passed
over when its bound is below the weakest kth score of its items: whole batches of items by documents
go at once, and no result can be lost, since scores are sums of products that are never negative.

A part of the documents is searched first; the kth scores found there start the search of all. They
only say what can be passed over. Each task keeps the best of its own batches, and the tasks' results
are ranked together. Items come in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import package_root, stored

TOP = 20
# Distinct terms of a block of items: what is sent to every task. A longer item is a block of its own.
BLOCK_TERMS = 1 << 16
ITEMS_LEAF, DOCS_LEAF, FAN = 8, 64, 16
# One document in PART is searched first.
PART = 16
# Bytes of text that are split at once.
CHUNK = 1 << 20

# Terms are made of digits, letters and all that is not ASCII; A-Z are lowered, the rest parts terms.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_counts(text: str | None) -> Counter[bytes]:
    """How often each term occurs in the whole text; null has none."""
    data = (text or "").encode().translate(_TERM_BYTES)
    found: Counter[bytes] = Counter()
    start = 0
    while start < len(data):
        end = data.find(b" ", start + CHUNK)
        end = len(data) if end < 0 else end
        found.update(data[start:end].split())
        start = end
    return found


def posting_batches(batches: Iterator[pa.RecordBatch], places: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """``doc_id``, ``n`` terms, and the ``places`` of the known ones with their counts ``tf``."""
    for batch in batches:
        sizes, terms, times = [], [], []
        for text in batch.column(1).to_pylist():
            counts = term_counts(text)
            known = [(places[t], k) for t, k in counts.items() if t in places]
            sizes.append(counts.total())
            terms.append([t for t, _ in known])
            times.append([k for _, k in known])
        lists = pa.list_(pa.int32())
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, lists), pa.array(times, lists)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tf"])


@dataclass
class Items:
    """A block of items with a tree over them. ``order`` lists items so that each node is a range."""

    ids: list[int | None]
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    order: list[int] = field(default_factory=list)
    nodes: list[dict] = field(default_factory=list)

    def build(self) -> Items:
        self.order, self.nodes = [], []
        if self.ids:
            self._node(list(range(len(self.ids))))
        return self

    def _node(self, items: list[int]) -> int:
        number, start = len(self.nodes), len(self.order)
        self.nodes.append({})
        children: list[int] = []
        if len(items) <= ITEMS_LEAF:
            self.order += items
        else:
            children = [self._node(half) for half in self._halves(items)]
        maxima: dict[int, int] = {}
        for terms, weights in [(self.nodes[c]["terms"], self.nodes[c]["max"]) for c in children] or [
            (self.terms[i], self.weights[i]) for i in items
        ]:
            for t, w in zip(terms.tolist(), weights.tolist()):
                maxima[t] = max(w, maxima.get(t, 0))
        self.nodes[number] = {
            "start": start, "end": len(self.order), "children": children,
            "height": 1 + max((self.nodes[c]["height"] for c in children), default=-1),
            "terms": np.fromiter(maxima, np.int64, len(maxima)), "max": np.fromiter(maxima.values(), np.int64, len(maxima)),
        }
        return number

    def _halves(self, items: list[int]) -> tuple[list[int], list[int]]:
        """Items nearer to one and to the other of two that share little."""

        def shared(a: int, b: int) -> float:
            both, at, _ = np.intersect1d(self.terms[a], self.terms[b], return_indices=True)
            return float(self.weights[a][at].sum()) if len(both) else 0.0

        first = items[0]
        second = min(items[1:], key=lambda i: shared(first, i))
        lean = {i: shared(first, i) - shared(second, i) for i in items}
        ranked = sorted(items, key=lambda i: -lean[i])
        cut = sum(x > 0 for x in lean.values())
        # Neither side is left with less than a leaf.
        cut = min(max(cut, ITEMS_LEAF // 2), len(items) - ITEMS_LEAF // 2)
        return ranked[:cut], ranked[cut:]


@dataclass
class Best:
    """The best documents of each item so far, and the score that a further one needs at least."""

    top: int
    floor: np.ndarray
    scores: list[np.ndarray]
    docs: list[np.ndarray]

    @classmethod
    def start(cls, n: int, top: int, floor: np.ndarray | None = None) -> Best:
        nothing = np.zeros(0, np.int64)
        least = np.ones(n, np.int64) if floor is None else np.maximum(floor, 1)
        return cls(top, least, [nothing] * n, [nothing] * n)

    def offer(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        good = scores >= self.floor[item]
        if not good.any():
            return
        scores = np.concatenate([self.scores[item], scores[good]])
        docs = np.concatenate([self.docs[item], docs[good]])
        kept = np.lexsort((docs, -scores))[: self.top]
        self.scores[item], self.docs[item] = scores[kept], docs[kept]
        if len(kept) == self.top:
            self.floor[item] = max(self.floor[item], self.scores[item][-1])


class Kinds(NamedTuple):
    """For each term the leaf of the item tree that weighs it most, and that weight."""

    leaf: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, items: Items, width: int) -> Kinds:
        leaf, most = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for number, node in enumerate(x for x in items.nodes if not x["children"]):
            more = node["max"] > most[node["terms"]]
            at = node["terms"][more]
            leaf[at], most[at] = number, node["max"][more]
        return cls(leaf, most)


class DocumentTree:
    """A tree over the documents of a batch, each with its terms and impacts."""

    def __init__(self, docs: np.ndarray, ptr: np.ndarray, terms: np.ndarray, impacts: np.ndarray, kinds: Kinds):
        lengths = np.diff(ptr)
        # Documents with the same kind of terms, then of like length, stand together: tighter maxima.
        owner = np.repeat(np.arange(len(docs)), lengths)
        groups = int(kinds.leaf.max(initial=0)) + 1
        pull = impacts * kinds.weight[terms].astype(float)
        lean = np.bincount(owner * groups + kinds.leaf[terms], pull, len(docs) * groups).reshape(len(docs), groups)
        order = np.lexsort((lengths, lean.argmax(1)))
        place = np.empty(len(docs), np.int64)
        place[order] = np.arange(len(docs))
        self.docs, self.width = docs[order], len(kinds.leaf)
        posted = np.argsort(place[owner], kind="stable")
        self.terms, self.impacts, self.owner = terms[posted], impacts[posted], place[owner][posted]
        self.levels = [self._leaves()]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(np.stack([below[k : k + FAN].max(0) for k in range(0, len(below), FAN)]))

    def _leaves(self) -> np.ndarray:
        leaves = -(-len(self.docs) // DOCS_LEAF)
        maxima = np.zeros(leaves * self.width, np.int32)
        np.maximum.at(maxima, self.owner // DOCS_LEAF * self.width + self.terms, self.impacts.astype(np.int32))
        return maxima.reshape(leaves, self.width)

    def leaf(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Impacts of a leaf's documents by term, and their ids."""
        first, last = number * DOCS_LEAF, min(len(self.docs), (number + 1) * DOCS_LEAF)
        a, b = np.searchsorted(self.owner, [first, last])
        table = np.zeros((self.width, last - first), np.int64)
        table[self.terms[a:b], self.owner[a:b] - first] = self.impacts[a:b]
        return table, self.docs[first:last]


def search(items: Items, tree: DocumentTree, best: Best) -> int:
    """Improve ``best`` by the documents of ``tree``; returns how many scores were computed."""
    if not items.nodes or not len(tree.docs):
        return 0
    scored, order = 0, np.array(items.order)
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bound(q: int, level: int, d: int) -> int:
        node = items.nodes[q]
        return int((tree.levels[level][d][node["terms"]] * node["max"]).sum())

    def needed(q: int) -> int:
        node = items.nodes[q]
        return int(best.floor[order[node["start"] : node["end"]]].min())

    top = len(tree.levels) - 1
    stack = [(bound(0, top, 0), 0, top, 0)]
    while stack:
        limit, q, level, d = stack.pop()
        if limit < needed(q):
            continue
        node = items.nodes[q]
        if level == 0 and not node["children"]:
            if d not in tables:
                tables.clear()
                tables[d] = tree.leaf(d)
            table, docs = tables[d]
            for i in order[node["start"] : node["end"]].tolist():
                scores = items.weights[i] @ table[items.terms[i]]
                scored += len(scores)
                best.offer(i, scores, docs)
            continue
        if node["children"] and node["height"] >= level:
            pairs = [(c, level, d) for c in node["children"]]
        else:
            pairs = [(q, level - 1, k) for k in range(d * FAN, min((d + 1) * FAN, len(tree.levels[level - 1])))]
        # The most promising pair comes last, to be taken first.
        stack += sorted((bound(*p), *p) for p in pairs)
    return scored


@dataclass
class Statistics:
    """What scores need of all documents."""

    n_docs: int
    n_terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 75 + (25 * n * self.n_docs) // max(1, self.n_terms)
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


NO_ID = np.iinfo(np.int64).max


def search_batches(
    batches: Iterator[pa.RecordBatch], items: Items, stats: Statistics, kinds: Kinds, top: int, floor: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    """``item`` (its number), ``doc_id`` and ``score`` of the best documents of all ``batches``."""
    best = Best.start(len(items.ids), top, floor)
    for batch in batches:
        if not batch.num_rows:
            continue
        # A missing id comes after all others.
        docs = batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        lists = batch.column(2)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        ptr = np.concatenate([[0], np.cumsum(lengths)])
        terms = lists.flatten().to_numpy().astype(np.int64)
        tf = batch.column(3).flatten().to_numpy().astype(np.int64)
        n = np.repeat(batch.column(1).to_numpy(), lengths)
        search(items, DocumentTree(docs, ptr, terms, stats.impacts(tf, n), kinds), best)
    numbers = np.repeat(np.arange(len(items.ids), dtype=np.int32), [len(s) for s in best.scores])
    docs, scores = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (best.docs, best.scores))
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers), pa.array(docs, mask=docs == NO_ID), pa.array(scores)], ["item", "doc_id", "score"]
    )


def item_blocks(items: DataFrame, limit: int = BLOCK_TERMS) -> Iterator[list[tuple[int | None, Counter[bytes]]]]:
    """Items with their terms, a block at a time; only one block is on the driver."""
    block, terms = [], set()
    for row in items.select("item_id", "text").toLocalIterator():
        counts = term_counts(row["text"])
        if block and len(terms | counts.keys()) > limit:
            yield block
            block, terms = [], set()
        block.append((row["item_id"], counts))
        terms |= counts.keys()
    if block:
        yield block


def _with_package(root: str) -> None:
    import sys

    if root not in sys.path:
        sys.path.append(root)


def _postings(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    root = package_root()

    def run(batches):
        _with_package(root)
        from starmart.llm import dual_tree

        yield from dual_tree.posting_batches(batches, places)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tf array<int>"), "postings")


def _searched(postings: DataFrame, items: Items, stats: Statistics, kinds: Kinds, top: int, floor: np.ndarray | None) -> DataFrame:
    """``item``, ``doc_id``, ``score`` and ``rank`` of the best documents of each item, written."""
    root = package_root()

    def run(batches):
        _with_package(root)
        from starmart.llm import dual_tree

        yield from dual_tree.search_batches(batches, items, stats, kinds, top, floor)

    found = postings.mapInArrow(run, "item int, doc_id bigint, score bigint")
    ranks = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return stored(found.withColumn("rank", ranks).filter(F.col("rank") <= top), "ranked")


def _block_ranking(block: list[tuple[int | None, Counter[bytes]]], docs: DataFrame, top: int, part: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted(set().union(*[counts.keys() for _, counts in block]))
    places = {t: n for n, t in enumerate(vocabulary)}
    postings = _postings(docs, places)
    sums = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    stats = Statistics(sums["docs"], sums["terms"])
    # At most one row per term of the block.
    counted = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = {r["term"]: r["df"] for r in counted.collect()}
    items = Items([i for i, _ in block], [], [])
    for _, counts in block:
        known = [(places[t], k) for t, k in counts.items() if places[t] in df]
        items.terms.append(np.array([t for t, _ in known], np.int64))
        items.weights.append(np.array([k * stats.weight(df[t]) for t, k in known], np.int64))
    items.build()
    kinds = Kinds.of(items, max(1, len(vocabulary)))
    first = _searched(postings.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(part)) == 0), items, stats, kinds, top, None)
    floor = np.zeros(len(block), np.int64)
    # One number per item of the block.
    for r in first.filter(F.col("rank") == top).select("item", "score").collect():
        floor[r["item"]] = r["score"]
    names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "item int, item_id bigint")
    ranked = _searched(postings, items, stats, kinds, top, floor)
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, part: int = PART, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` documents of highest score for each row of ``items(item_id, text)``: ``item_id``,
    ``rank`` from 1, ``doc_id`` and ``score``, exactly.

    Equal scores are ranked by ascending ``doc_id``, null ids last. A document without a term of the item
    is not ranked, so an item may have fewer rows, and one without terms has none. Every row counts as a
    document, and every item row is ranked by itself, also if repeated; null texts have no terms. An empty
    table on either side gives no rows. Texts of any length are split in chunks. Other columns are ignored.
    """
    out: DataFrame | None = None
    for block in item_blocks(items, block_terms):
        found = _block_ranking(block, docs, top, part)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out
