"""Keys made from several columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms of a start time inside a composed key. The 12-hour form is what the
# warehouse spelling of the key produces; it cannot tell 01:00 from 13:00.
TIME_KEY_24H = "yyyy-MM-dd-HH-mm-ss"
TIME_KEY_12H = "yyyy-MM-dd-hh-mm-ss"


def time_key(column: Column | str, fmt: str = TIME_KEY_24H) -> Column:
    return F.date_format(column, fmt)


def compose_key(columns: Iterable[Column | str], sep: str = "") -> Column:
    """Columns as one text key; null as soon as one of them is null."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [texts[0]]
    for text in texts[1:]:
        if sep:
            parts.append(F.lit(sep))
        parts.append(text)
    return F.concat(*parts)


def hash_key(columns: Iterable[Column | str]) -> Column:
    """Stable 64-bit key: the same values give the same key in every run.

    ``xxhash64`` skips nulls, so each column is hashed with a marker of its null state.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*[part for c in cols for part in (c.isNull(), c)])
