"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models on hashed words; each later model also
gets the probabilities of the earlier categories. For its training rows those are out-of-fold
predictions, so that it learns from probabilities as good as those it will meet.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import package_root
from starmart.llm.learn import fit_logistic, sigmoid

# The last category is the one decided on; the others say in what kind of text it shows.
CATEGORIES = ("toxic_junk", "toxic_prose", "toxic")
# Labelled rows that the models are fitted on, at most; chosen by a hash of the id.
TRAIN_ROWS = 8000
BUCKETS = 1 << 22
# Words kept per model, by how much their share differs between the classes.
FEATURES = 400
MIN_DOCS = 3
FOLDS = 3
THRESHOLD = 0.5
L2 = 1.0
STEPS = 150
# A toxic row counts for as many rows as balances the classes, up to this.
MAX_POSITIVE = 4.0
PREFIX = 5
_LETTERS = re.compile(r"[^\W\d_]+")


def text_buckets(text: str) -> set[int]:
    """Hashes of the distinct lower-case words of the whole text, and of their first letters."""
    words = set(_LETTERS.findall(text.lower()))
    crc, mask = zlib.crc32, BUCKETS - 1
    found = {crc(w.encode()) & mask for w in words}
    found.update(crc(b"^" + p.encode()) & mask for p in {w[:PREFIX] for w in words if len(w) > PREFIX})
    return found


@dataclass
class Chain:
    """Fitted models: a row of weights per bucket and category, intercepts, and the weights of the
    probabilities of earlier categories."""

    place: dict[int, int]
    weights: np.ndarray
    intercepts: np.ndarray
    earlier: np.ndarray

    def score(self, text: str) -> list[float]:
        place = self.place
        hit = [place[b] for b in text_buckets(text) if b in place]
        raw = self.weights[hit].sum(axis=0) + self.intercepts
        found: list[float] = []
        for k in range(len(raw)):
            found.append(float(sigmoid(np.array(raw[k] + np.dot(self.earlier[k, :k], found)))))
        return found


def _screened(
    rows: np.ndarray, cols: np.ndarray, y: np.ndarray, use: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The buckets whose share of texts differs most between the classes, among the rows in use, in
    order, and the logarithm of the ratio of the shares."""
    inside = use[rows]
    positive = np.bincount(cols[inside & (y[rows] == 1)], minlength=BUCKETS)
    all_of = np.bincount(cols[inside], minlength=BUCKETS)
    seen = np.flatnonzero(all_of >= MIN_DOCS)
    n1, n0 = max(1, int((y[use] == 1).sum())), max(1, int((y[use] == 0).sum()))
    p1, p0, p = positive[seen] / n1, (all_of[seen] - positive[seen]) / n0, all_of[seen] / (n1 + n0)
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    ratio = np.log((positive[seen] + 0.5) / (n1 + 1)) - np.log((all_of[seen] - positive[seen] + 0.5) / (n0 + 1))
    best = np.sort(np.lexsort((seen, -z))[:FEATURES])
    return seen[best], ratio[best]


def _dense(rows: np.ndarray, cols: np.ndarray, n: int, order: np.ndarray) -> np.ndarray:
    at = np.searchsorted(order, cols)
    at[at == len(order)] = 0
    hit = order[at] == cols if len(order) else np.zeros(len(cols), bool)
    x = np.zeros((n, len(order)), np.float32)
    x[rows[hit], at[hit]] = 1.0
    return x


def fit_chain(buckets: list[np.ndarray], labels: np.ndarray, folds: int = FOLDS) -> Chain:
    """Fit on texts given by their buckets and ``labels`` (a column of 0 and 1 per category)."""
    n, m = len(buckets), labels.shape[1]
    rows = np.repeat(np.arange(n), [len(b) for b in buckets]) if n else np.zeros(0, np.int64)
    cols = np.concatenate(buckets).astype(np.int64) if n else np.zeros(0, np.int64)
    fold = np.arange(n) % folds
    held = np.zeros((n, m))
    parts, intercepts, earlier = [], np.full(m, -10.0), np.zeros((m, m))
    for k in range(m):
        y = labels[:, k]

        def model(use: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
            # A bucket counts by its log ratio, so that rare but telling words weigh in.
            chosen, ratio = _screened(rows, cols, y, use)
            words = _dense(rows, cols, n, chosen) * ratio.astype(np.float32)
            x = np.hstack([words, held[:, :k].astype(np.float32)])
            ones = max(1.0, float(y[use].sum()))
            positive = min(MAX_POSITIVE, max(1.0, (use.sum() - ones) / ones))
            w, b = fit_logistic(x[use], y[use].astype(np.float32), L2, STEPS, positive=positive)
            w[: len(chosen)] *= ratio
            x[:, : len(chosen)] = words / np.where(ratio == 0, 1, ratio)
            return chosen, w, b, x

        for f in range(folds):
            w, b, x = model(fold != f)[1:]
            held[fold == f, k] = sigmoid(x[fold == f] @ w + b)
        if n:
            chosen, w, b, _ = model(np.ones(n, bool))
            parts.append((chosen, w[: len(chosen)]))
            intercepts[k], earlier[k, :k] = b, w[len(chosen) :]
        else:
            parts.append((np.zeros(0, np.int64), np.zeros(0)))
    known = sorted({int(b) for chosen, _ in parts for b in chosen})
    place = {b: i for i, b in enumerate(known)}
    weights = np.zeros((len(known), m))
    for k, (chosen, w) in enumerate(parts):
        weights[[place[int(b)] for b in chosen], k] = w
    return Chain(place, weights, intercepts, earlier)


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """At most ``limit`` labelled texts as ``quality``, ``toxic`` and their buckets in 4-byte numbers."""
    root = package_root()

    @F.pandas_udf("binary")
    def buckets(texts: pd.Series) -> pd.Series:
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from starmart.llm.toxicity import text_buckets

        return texts.map(lambda t: np.array(sorted(text_buckets(t)), "<u4").tobytes())

    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality"), F.col("toxic")]
    whole = labels.select("doc_id", "quality", "toxic").dropna()
    sample = whole.orderBy(*order).limit(limit)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    hashed = found.select(
        "doc_id", "quality", "toxic", buckets(F.coalesce("text", F.lit(""))).alias("buckets")
    )
    return hashed.orderBy(*order, "buckets").limit(limit).select("quality", "toxic", "buckets")


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Chain:
    """A chain for ``CATEGORIES`` from ``labels(doc_id, quality, toxic)``.

    Labelled rows with a null, and those without a document, are left out; with none at all nothing
    is found toxic.
    """
    rows = training_rows(docs, labels, limit).collect()  # at most ``limit``
    quality = np.array([r["quality"] for r in rows], float)
    toxic = np.array([r["toxic"] for r in rows], float)
    targets = np.column_stack([toxic * (1 - quality), toxic * quality, toxic]) if rows else np.zeros((0, 3))
    return fit_chain([np.frombuffer(r["buckets"], "<u4") for r in rows], targets)


def probabilities(text: Column, chain: Chain) -> Column:
    """A struct of the probability of each category; null texts count as empty."""
    root = package_root()
    parts = (chain.place, chain.weights, chain.intercepts, chain.earlier)

    @F.pandas_udf(", ".join(f"{c} double" for c in CATEGORIES))
    def score(texts: pd.Series) -> pd.DataFrame:
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from starmart.llm.toxicity import CATEGORIES, Chain

        chain = Chain(*parts)
        return pd.DataFrame([chain.score(t) for t in texts], columns=list(CATEGORIES))

    return score(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the probability ``p_<category>`` of each category, ``score`` (that of the last),
    ``toxic`` (from ``threshold`` on) and ``kept`` (not toxic), one row per row of ``docs``.

    Null texts count as empty; repeated rows are classified alike; other columns are ignored. An empty
    table gives no rows. Of a very long text only the different words are held.
    """
    scored = docs.select("doc_id", probabilities(F.col("text"), chain).alias("p"))
    return scored.select(
        "doc_id",
        *[F.col(f"p.{c}").alias(f"p_{c}") for c in CATEGORIES],
        F.col(f"p.{CATEGORIES[-1]}").alias("score"),
        (F.col(f"p.{CATEGORIES[-1]}") >= threshold).alias("toxic"),
        (F.col(f"p.{CATEGORIES[-1]}") < threshold).alias("kept"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns kept; no row is moved."""
    score = probabilities(F.col("text"), train(docs, labels))
    return docs.filter(score[CATEGORIES[-1]] < threshold)
