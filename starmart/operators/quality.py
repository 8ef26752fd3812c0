"""Quality checks: each returns a DataFrame; raising is a separate, explicit step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.schemas import TableSpec


class QualityError(ValueError):
    """A table did not pass a check."""


@dataclass(frozen=True)
class TableCheck:
    """``frame`` has one row per table: ``table_name``, ``n_rows``, ``ok``."""

    frame: DataFrame

    def raise_if_failed(self) -> None:
        failed = self.frame.filter(~F.col("ok")).select("table_name", "n_rows").collect()
        if failed:
            names = ", ".join(f"{r.table_name} ({r.n_rows} rows)" for r in failed)
            raise QualityError(f"too few rows: {names}")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name``, ``n_rows`` for every table, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def check_min_rows(tables: Mapping[str, DataFrame], min_rows: int = 1) -> TableCheck:
    """Every table must hold at least ``min_rows`` rows."""
    return TableCheck(row_counts(tables).withColumn("ok", F.col("n_rows") >= min_rows))


def check_unique(df: DataFrame, pk: str | Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their count; empty when the key is unique."""
    keys = [pk] if isinstance(pk, str) else list(pk)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_not_null(df: DataFrame, cols: Sequence[str], blank: bool = False) -> DataFrame:
    """One row with the number of nulls (and blanks, if ``blank``) per column."""

    def gap(c: str):
        test = F.col(c).isNull()
        return test | (F.col(c).cast("string") == "") if blank else test

    return df.agg(*[F.count_if(F.coalesce(gap(c), F.lit(False))).alias(c) for c in cols])


def check_keys(df: DataFrame, spec: TableSpec) -> None:
    """Fail unless the key of ``spec`` is unique in ``df`` and no column that must not be null is."""
    repeated = check_unique(df, spec.pk).limit(3).collect()
    if repeated:
        raise QualityError(f"{spec.name}: repeated keys, e.g. {[tuple(r)[:-1] for r in repeated]}")
    gaps = check_not_null(df, spec.not_null).first().asDict() if spec.not_null else {}
    if any(gaps.values()):
        raise QualityError(f"{spec.name}: nulls in {[c for c, n in gaps.items() if n]}")


def preview(df: DataFrame, n: int = 2, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` a top-n that needs no full sort."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
