"""Quality rules with tokeniser fertility.

Base rules count words, symbols, repeated lines and repeated word windows. Two public vocabularies then
measure the text: one with byte fallback gives characters per token, the share of byte tokens and
token entropy; a byte-level one for many languages gives, over the text's different words,
characters per token and the share of tokens that are no whole characters. A text outside the band of its language (of its script where the language is missing or rare) is rejected; without either
band the method rejects nothing. Bands are quantiles over all documents of the language or script.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import package_root, stored
from starmart.llm.pieces import encoder, model_bytes

MIN_WORDS = 50
MAX_REPEATED_SHARE = 50
# Tokens per block whose entropy is taken: a measure that does not grow with the text's length.
BLOCK = 256
# A language or script gets a band from this many documents that pass the base rules, whatever else
# the table holds.
MIN_ROWS = 50
# Measures of short texts scatter more: a band is wider by this many tokens over the text's number.
SHORT = 100
SYMBOLS = b"#*$%&|<>"
SCRIPTS = {
    "Latin": "A-Za-zÀ-ÖØ-öø-ɏ",
    "Greek": "Ͱ-Ͽ",
    "Cyrillic": "Ѐ-ӿ",
    "Hebrew": "֐-׿",
    "Arabic": "؀-ۿ",
    "Devanagari": "ऀ-ॿ",
    "Thai": "฀-๿",
    "Kana": "぀-ヿ",
    "Han": "一-鿿",
    "Hangul": "가-힯",
    "Armenian": "\u0531-\u058a",
    "Bengali": "\u0980-\u09ff",
    "Gurmukhi": "\u0a00-\u0a7f",
    "Gujarati": "\u0a80-\u0aff",
    "Tamil": "\u0b80-\u0bff",
    "Telugu": "\u0c00-\u0c7f",
    "Kannada": "\u0c80-\u0cff",
    "Malayalam": "\u0d00-\u0d7f",
    "Sinhala": "\u0d80-\u0dff",
    "Lao": "\u0e80-\u0eff",
    "Tibetan": "\u0f00-\u0fff",
    "Myanmar": "\u1000-\u109f",
    "Georgian": "\u10a0-\u10ff",
    "Ethiopic": "\u1200-\u139f",
    "Khmer": "\u1780-\u17ff",
}
# The script of each code point of the basic plane, as a number from 1; 0 for all others.
_NAMES = sorted(SCRIPTS)
_SCRIPT_OF = np.zeros(1 << 16, np.uint8)
for _name, _ranges in SCRIPTS.items():
    for _first, _last in zip(_ranges[::3], _ranges[2::3]):
        _SCRIPT_OF[ord(_first) : ord(_last) + 1] = _NAMES.index(_name) + 1
SPACES = b" \t\n\x0b\x0c\r"
# Bytes or characters of a text that are split or counted at once.
CHUNK = 1 << 20
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
# Characters of a run without white space that the byte-level vocabulary is given at once.
LONGEST = 1024


class Band(NamedTuple):
    """How far from the quartiles a measure may be: ``reach`` times their distance, or ``least`` times
    the median, whichever is more; ``low`` and ``high`` say which sides count."""

    measure: str
    reach: float
    least: float
    low: bool
    high: bool
    floor: float = 0.0


BANDS = (
    Band("chars_per_token", 4.0, 0.05, True, True),
    Band("byte_share", 4.0, 0.0, False, True, 0.05),
    Band("entropy", 4.0, 0.05, True, False),
    Band("chars_per_byte_token", 4.0, 0.05, True, True),
    Band("partial_share", 4.0, 0.0, False, True, 0.05),
)


def word_numbers(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words as numbers in order of first appearance, four bytes each, and the different words."""
    numbers: dict[bytes, int] = {}
    parts, start = [], 0
    while start < len(data):
        end = data.find(b" ", start + CHUNK)
        end = len(data) if end < 0 else end
        # Split on bytes: exactly the six white-space characters.
        words = data[start:end].split()
        new = dict.fromkeys(words) if not numbers else [w for w in dict.fromkeys(words) if w not in numbers]
        numbers.update(zip(new, range(len(numbers), len(numbers) + len(new))))
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        start = end
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), list(numbers)


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words in windows of three that occur more than once."""
    if len(ids) < 4:
        return 0
    wide = ids.astype(np.int64)
    pairs = wide[:-1] * distinct + wide[1:]
    if distinct > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + wide[2:]
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    covered = np.zeros(len(ids), bool)
    for hits in (order[1:][same], order[:-1][same]):
        for shift in range(3):
            covered[hits + shift] = True
    return int(covered.sum())


def counted(text: str) -> tuple[tuple[int, int, int, int, int], list[bytes]]:
    """Words, their code points, symbols, repeated lines, words in repeated windows of three; and the
    different words."""
    data = text.encode()
    ids, words = word_numbers(data)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    chars = len(text) - (len(data) - len(data.translate(None, SPACES)))
    lines = [x for x in data.split(b"\n") if x.strip()]
    base = (len(ids), chars, symbols, len(lines) - len(set(lines)), repeated_words(ids, len(words)))
    return base, words


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    return counted(text)[0]


class ByteVocabulary:
    """Tokens of the different words of a text under a byte-level vocabulary.

    The words stand in a line, each once, so that a text is measured by what it is made of and not by what
    it repeats; lines are taken in chunks that end before a space. A run without white space that is longer than
    ``LONGEST`` characters is cut into such parts, as merging takes long in very long runs.
    """

    def __init__(self, ranks: bytes):
        import public_tokenizers
        import tiktoken

        parsed = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.tokens = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=parsed, special_tokens={})
        self.partial = np.zeros(max(parsed.values()) + 1, bool)
        self.partial[[i for b, i in parsed.items() if not _is_text(b)]] = True

    def counts(self, words: list[bytes]) -> tuple[int, int, int]:
        """Characters of the line, its tokens, and those that are no whole characters."""
        text = b" ".join(words).decode()
        if max(map(len, words), default=0) > LONGEST:
            text = _RUN.sub(lambda m: m.group() + " ", text)
        total = partial = start = 0
        while start < len(text):
            end = text.find(" ", start + CHUNK)
            end = len(text) if end < 0 else end
            ids = self.tokens.encode_ordinary(text[start:end])
            total += len(ids)
            partial += int(self.partial[ids].sum())
            start = end
        return len(text), total, partial


_RUN = re.compile(r"[^\x20\x09-\x0D]{%d}(?=[^\x20\x09-\x0D])" % LONGEST)


def _is_text(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


def byte_ranks(path: str | None = None) -> bytes:
    """The file of the byte-level vocabulary, by default the public one for many languages; read on the
    driver and sent along with the task."""
    import public_tokenizers

    return Path(path or public_tokenizers.path(BYTE_RANKS)).read_bytes()


_VOCABULARIES: dict[bytes, ByteVocabulary] = {}


def vocabulary(ranks: bytes) -> ByteVocabulary:
    """The worker's vocabulary, made once per process."""
    key = hashlib.sha256(ranks).digest()
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = ByteVocabulary(ranks)
    return _VOCABULARIES[key]


def block_entropy(ids: np.ndarray, block: int = BLOCK) -> float:
    """Mean entropy in bits of blocks of tokens; the last one takes the remainder; 0 if empty."""
    n = len(ids) // block
    if len(ids) == 0:
        return 0.0

    def entropies(rows: np.ndarray) -> np.ndarray:
        width = rows.shape[1]
        ordered = np.sort(rows, axis=1)
        new = np.ones(ordered.shape, bool)
        new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
        starts = np.flatnonzero(new.ravel())
        runs = np.diff(np.append(starts, ordered.size)) / width
        row = starts // width
        return np.bincount(row, -runs * np.log2(runs), rows.shape[0])

    tail = ids[max(0, n - 1) * block :]
    whole = ids[: max(0, n - 1) * block].reshape(-1, block)
    total = float(entropies(tail.reshape(1, -1))[0]) * len(tail)
    for at in range(0, len(whole), 1024):
        total += float(entropies(whole[at : at + 1024]).sum()) * block
    return total / len(ids)


def script(text: str) -> str:
    """The script of most letters (of equal ones the last by name), "none" without any."""
    counts = np.zeros(len(_NAMES) + 1, np.int64)
    for start in range(0, len(text), CHUNK):
        points = np.frombuffer(text[start : start + CHUNK].encode("utf-32-le"), np.uint32)
        known = _SCRIPT_OF[np.where(points < 1 << 16, points, 0)]
        counts += np.bincount(known, minlength=len(counts))
    found = counts[1:]
    return _NAMES[len(found) - 1 - int(found[::-1].argmax())] if found.any() else "none"


def measure_batches(batches: Iterator[pa.RecordBatch], model: bytes, ranks: bytes) -> Iterator[pa.RecordBatch]:
    enc, by_bytes = encoder(model), vocabulary(ranks)
    names = ["doc_id", "lang", "script", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names += ["n_tokens", "chars_per_token", "byte_share", "entropy"]
    names += ["byte_tokens", "chars_per_byte_token", "partial_share"]
    for batch in batches:
        rows = []
        for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            ids = enc.ids(text)
            n = len(ids)
            share = float(enc.is_byte[ids].sum()) / n if n else 0.0
            base, words = counted(text)
            chars, tokens, partial = by_bytes.counts(words)
            measured = (n, len(text) / n if n else 0.0, share, block_entropy(ids))
            again = (tokens, chars / tokens if tokens else 0.0, partial / tokens if tokens else 0.0)
            rows.append((lang or None, script(text), *base, *measured, *again))
        kinds = [*[pa.string()] * 2, *[pa.int64()] * 6, *[pa.float64()] * 3, pa.int64(), *[pa.float64()] * 2]
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)


def measures(docs: DataFrame, model: bytes | None = None, ranks: bytes | None = None) -> DataFrame:
    """Base counts and token measures of each row, its ``lang`` (null if empty) and its ``script``.
    Null texts count as empty."""
    model, ranks = model or model_bytes(), ranks or byte_ranks()
    root = package_root()

    def run(batches):
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from starmart.llm import fertility

        yield from fertility.measure_batches(batches, model, ranks)

    key = docs.schema["doc_id"].dataType.simpleString()
    counts = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    tokens = "n_tokens bigint, chars_per_token double, byte_share double, entropy double, "
    tokens += "byte_tokens bigint, chars_per_byte_token double, partial_share double"
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    return texts.mapInArrow(run, f"doc_id {key}, lang string, script string, {counts}, {tokens}")


def base_failed() -> Column:
    repeated = F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED_SHARE) * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def fit_bands(measured: DataFrame, by: str, bands: tuple[Band, ...] = BANDS) -> DataFrame:
    """Limits per value of ``by``, ``lang`` or ``script``: ``<measure>_low``, ``_high`` and ``_slack`` (how
    far they are from the quartiles), for all with ``MIN_ROWS`` documents that pass the base rules.

    Quartiles are exact, of values rounded to hundredths, so that what a task keeps is bounded. Letters
    of no known script are of many languages and give no band.
    """
    passed = measured.filter(~base_failed() & F.col(by).isNotNull() & (F.col(by) != ("none" if by == "script" else "")))
    quartiles = [
        F.percentile(F.round(b.measure, 2), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(b.measure)
        for b in bands
    ]
    own = passed.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *quartiles).filter(F.col("n") >= MIN_ROWS)
    limits = []
    for b in bands:
        q1, q2, q3 = (F.get(F.col(b.measure), F.lit(i)) for i in range(3))
        slack = F.greatest((q3 - q1) * b.reach, q2 * b.least, F.lit(b.floor))
        limits.append((q1 - slack if b.low else F.lit(float("-inf"))).alias(f"{b.measure}_low"))
        limits.append((q3 + slack if b.high else F.lit(float("inf"))).alias(f"{b.measure}_high"))
        limits.append(slack.alias(f"{b.measure}_slack"))
    return own.select(by, *limits)


def rate(
    docs: DataFrame, model: bytes | None = None, bands: tuple[Band, ...] = BANDS, ranks: bytes | None = None
) -> DataFrame:
    """One row per row of ``docs`` with all measures, ``base_failed``, the method's ``rejected`` and
    ``kept`` (neither). Where neither the language nor the script has a band, the method rejects nothing.

    Null texts count as empty, which fail the base rules. Repeated rows are rated alike; other columns are
    ignored; an empty table gives no rows. Texts of any length are counted in chunks, with four bytes a
    word beside the different words."""
    measured = stored(measures(docs, model, ranks), "fertility")
    joined, names = measured, []
    for by in ("lang", "script"):
        limits = stored(fit_bands(measured, by, bands), f"fertility-bands-{by}")
        new = [f"{by}_{c}" for c in limits.columns if c != by]
        joined = joined.join(limits.toDF(by, *new), by, "left")
        names += new

    def limit(name: str) -> Column:
        return F.coalesce(F.col(f"lang_{name}"), F.col(f"script_{name}"))

    inside = F.lit(True)
    for b in bands:
        value, more = F.col(b.measure), limit(f"{b.measure}_slack") * SHORT / F.greatest("n_tokens", F.lit(1))
        for ok in (value >= limit(f"{b.measure}_low") - more, value <= limit(f"{b.measure}_high") + more):
            inside = inside & F.coalesce(ok, F.lit(True))
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("rejected", ~inside)
        .withColumn("kept", ~F.col("base_failed") & inside)
        .drop(*names)
    )


def filter_quality(docs: DataFrame, rated: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` was kept."""
    kept = rated.filter("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("__id")), "left_semi")
