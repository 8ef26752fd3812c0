"""Audits: what the new rows of a load must satisfy before anybody can read them.

Nulls and rules are counted by the tasks that write the rows aside, and keys are compared among the
new rows only: that they are not in the target is what the load itself makes sure of. So an audit
costs as much as the batch, however large the table is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.quality import QualityError, check_unique
from starmart.schemas import TableSpec


@dataclass(frozen=True)
class Audit:
    """``min_rows``: rows of the table with the new ones. ``rules``: name -> condition that must be true for
    every new row; unknown counts as false. ``unique`` and ``not_null`` name columns, by default those of
    the table's definition."""

    min_rows: int = 0
    rules: Mapping[str, Column] = field(default_factory=dict)
    unique: Sequence[str] | None = None
    not_null: Sequence[str] | None = None

    def metrics(self, spec: TableSpec) -> list[Column]:
        """Counts to be observed while the rows are written."""
        columns = spec.not_null if self.not_null is None else self.not_null
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in columns]
        broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"rule {name}") for name, rule in self.rules.items()]
        return nulls + broken

    def check(self, spec: TableSpec, new: DataFrame, observed: Mapping[str, int], target: DataFrame | None = None) -> None:
        """Raise unless the rows of ``new``, already written aside, may be published."""
        wrong = [f"{n} rows fail {name!r}" for name, n in observed.items() if name.startswith(("null ", "rule ")) and n]
        keys = list(spec.pk if self.unique is None else self.unique)
        if keys and not wrong:
            repeated = check_unique(new.select(*keys), keys).limit(3).collect()
            wrong += [f"repeated key {tuple(r)[:-1]}" for r in repeated]
        missing = self.min_rows - observed["n"]
        if missing > 0 and not (target is not None and _has(target, missing)):
            wrong.append(f"fewer than {self.min_rows} rows")
        if wrong:
            raise QualityError(f"{spec.name}: {'; '.join(wrong)}")


def has_rows(df: DataFrame) -> bool:
    """Stops at the first row found."""
    return not df.isEmpty()


def _has(df: DataFrame, rows: int) -> bool:
    return has_rows(df) if rows == 1 else df.limit(rows).count() == rows
