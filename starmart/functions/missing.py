"""A missing value in the logs is either null or a blank string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.isNull() | (c.cast("string") == "")


def is_present(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & (c.cast("string") != "")
