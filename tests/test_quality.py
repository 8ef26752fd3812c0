import pytest

from starmart.operators import (
    QualityError,
    check_min_rows,
    check_not_null,
    check_unique,
    preview,
    row_counts,
)
from conftest import rows


def test_min_rows_reports_all_and_raises_on_demand(spark):
    tables = {"full": spark.range(3), "empty": spark.range(0)}
    check = check_min_rows(tables)
    assert rows(check.frame) == [("empty", 0, False), ("full", 3, True)]
    with pytest.raises(QualityError, match="empty"):
        check.raise_if_failed()
    check_min_rows({"full": spark.range(3)}, 3).raise_if_failed()
    assert rows(row_counts(tables)) == [("empty", 0), ("full", 3)]


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, ""), (2, None), (None, "b"), (None, "c")], "k int, v string")
    assert rows(check_unique(df, "k")) == [(1, 2), (None, 2)]
    assert check_unique(df, ["k", "v"]).count() == 0
    assert tuple(check_not_null(df, ["k", "v"]).first()) == (2, 1)
    assert tuple(check_not_null(df, ["k", "v"], blank=True).first()) == (2, 2)


def test_preview(spark):
    assert preview(spark.range(10)).count() == 2
    assert rows(preview(spark.range(10), 3, ["id"])) == [(0,), (1,), (2,)]
