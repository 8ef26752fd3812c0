"""Row filters, imputation and the projection onto a table's columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import is_missing, is_present
from starmart.schemas import TableSpec


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def require_present(df: DataFrame, cols: Iterable[str], blank_ok: bool = False) -> DataFrame:
    """Keep rows whose ``cols`` are neither null nor (unless ``blank_ok``) blank.

    Only text can be blank, so other types get the plain null test that Parquet can evaluate.
    """
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.filter(
        _all(is_present(c) if c in text and not blank_ok else F.col(c).isNotNull() for c in cols)
    )


def require_finite(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows whose ``cols`` are neither null nor NaN."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.filter(
        _all(
            F.col(c).isNotNull() & ~F.isnan(c) if c in floating else F.col(c).isNotNull()
            for c in cols
        )
    )


def impute_missing(df: DataFrame, cols: Iterable[str], value: str) -> DataFrame:
    """Replace null and blank in ``cols`` by ``value``; the columns become text."""
    return df.withColumns(
        {c: F.when(is_missing(c), F.lit(value)).otherwise(F.col(c).cast("string")) for c in cols}
    )


def conform(df: DataFrame, spec: TableSpec, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, cast and reorder to ``spec``; ``mapping`` is table column -> input column.

    Text that is not a number becomes null (``try_cast``). Other casts keep Spark's ANSI rules, so
    a number that does not fit its column fails the job instead of being altered.
    """
    source = dict(mapping or {})
    types = {f.name: f.dataType for f in df.schema}
    out = []
    for field in spec.schema:
        name = source.get(field.name, field.name)
        c = F.col(name)
        if types[name] != field.dataType:
            from_text = isinstance(types[name], T.StringType)
            c = c.try_cast(field.dataType) if from_text else c.cast(field.dataType)
        out.append(c.alias(field.name))
    return df.select(out)
