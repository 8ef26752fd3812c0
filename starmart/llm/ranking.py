"""A quality classifier from preference pairs.

Bradley-Terry: the chance that one text is better than another is the logistic function of the
difference of their scores, linear in features of the whole text. The scores are then cut at the
quantile that leaves as many below as there are poor texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import package_root
from starmart.llm.learn import fit_logistic, sigmoid

# Labelled rows that the scores are learned from, at most, chosen by a hash of the id; pairs drawn
# per poor text, and in all.
TRAIN_ROWS = 8000
PAIRS_EACH = 60
MAX_PAIRS = 100_000
SEED = 5
FOLDS = 3
HELD_OUT = 1
SYMBOLS = b"#*$%&|<>"
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
NOT_ASCII = bytes(range(128, 256))
FEATURES = 18


def text_features(text: str) -> list[float]:
    """What the whole text looks like, language aside; zeros for a text without words."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if n == 0:
        return [0.0] * FEATURES
    lower = [w.lower() for w in words]
    distinct = len(set(lower))
    pairs = sum(a == b for a, b in zip(lower, lower[1:]))
    windows = len(set(zip(lower, lower[1:], lower[2:])))
    lines = [x for x in data.split(b"\n") if x.strip()]
    # Letters: A-Z, a-z and whatever is not ASCII; capitals: characters that lower() changes.
    ascii_letters = len(data) - len(data.translate(None, LETTERS))
    other = len(text) - len(data.translate(None, NOT_ASCII))
    letters = ascii_letters + other or 1
    low = text.lower()
    upper = 0
    if len(low) == len(text):
        upper = int((np.frombuffer(text.encode("utf-32-le"), "<u4") != np.frombuffer(low.encode("utf-32-le"), "<u4")).sum())
    lengths = np.fromiter(map(len, words), float, n)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    ended = sum(w[-1:] in b".,;:!?" for w in words)
    return [
        np.log1p(n),
        np.log1p(10 * symbols / n),
        upper / letters,
        np.log1p(10 * data.count(b"!") / n),
        np.log1p(10 * data.count(b"|") / n),
        distinct / n,
        pairs / n,
        (max(0, n - 2) - windows) / max(1, n - 2),
        1 - len(set(lines)) / len(lines),
        float(lengths.mean()),
        float(lengths.std()),
        digits / len(data),
        len(lines) / n,
        ended / n,
        letters / len(text),
        float((lengths <= 3).mean()),
        float(symbols > 0),
        float(n < 20),
    ]


@dataclass
class Ranking:
    """Learned scores: weights of standardised features, and the raw score that the cut is at."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, one half at the cut."""
        return sigmoid(self.raw(x) - self.cut)


def fit_ranking(x: np.ndarray, good: np.ndarray) -> Ranking:
    """Learn from features and labels (1 good, 0 poor); without both, all scores are one half."""
    if len(x) == 0:
        return Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    ranking = Ranking(mean, scale, np.zeros(x.shape[1]), 0.0)
    better, worse = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(better) or not len(worse):
        return ranking
    draw = np.random.default_rng(SEED)
    each = max(1, min(PAIRS_EACH, MAX_PAIRS // len(worse)))
    lost = np.repeat(worse, each)[:MAX_PAIRS]
    won = draw.choice(better, len(lost))
    z = np.clip((x - mean) / scale, -6, 6)
    ranking.weights, _ = fit_logistic(z[won] - z[lost], np.ones(len(lost)), l2=10.0, steps=400, intercept=False)
    # The cut lies half way between the scores on either side of the quantile.
    ordered = np.sort(ranking.raw(x))
    at = len(worse)
    ranking.cut = float((ordered[at - 1] + ordered[min(at, len(ordered) - 1)]) / 2)
    return ranking


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def _features(text: Column) -> Column:
    root = package_root()

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from starmart.llm.ranking import text_features

        return texts.map(text_features)

    return features(F.coalesce(text, F.lit("")))


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Ranking:
    """Learn from the labelled rows outside the held-out fold, ``labels(doc_id, quality)``.

    Rows with a null, and labels without a document, are left out.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality")]
    whole = labels.select("doc_id", "quality").dropna().filter(fold(F.col("doc_id")) != HELD_OUT)
    sample = whole.orderBy(*order).limit(limit)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    measured = found.select("doc_id", "quality", _features(F.col("text")).alias("x"))
    rows = measured.orderBy(*order, "x").limit(limit).collect()  # at most ``limit``
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), FEATURES)
    return fit_ranking(x, np.array([r["quality"] for r in rows]))


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1: good) of each row of ``docs``.

    Null texts count as empty; repeated rows are scored alike; other columns are ignored. An empty table
    gives no rows. A very long text is held as its list of words while its features are taken.
    """
    root = package_root()
    parts = (ranking.mean, ranking.scale, ranking.weights, ranking.cut)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from starmart.llm.ranking import FEATURES, Ranking, text_features

        x = np.array([text_features(t) for t in texts], float).reshape(len(texts), FEATURES)
        return pd.Series(Ranking(*parts).score(x))

    out = docs.select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        scored(F.coalesce("text", F.lit(""))).alias("score"),
    )
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
