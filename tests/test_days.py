import os
from datetime import date

import pytest
from conftest import rows

from starmart.schemas import table
from starmart.sinks import read_days, replace_days, replay_days

SPEC = table("t", "a int")
JANUARY = (date(2024, 1, 1), date(2024, 1, 31))


def dated(spark, *made):
    return spark.createDataFrame([(a, 2024, 1, d) for a, d in made], "a int, year int, month int, day int")


def content(spark, path):
    return rows(spark.read.schema("a int, year int, month int, day int").parquet(path).select("a", "day"))


def names(path, day):
    return sorted(os.listdir(f"{path}/year=2024/month=1/day={day}"))


def test_only_the_days_of_the_range_change(spark, folder):
    replace_days(dated(spark, (1, 1), (2, 2), (3, 3), (4, 4)), folder, *JANUARY)
    kept = names(folder, 1), names(folder, 4)
    done = replace_days(dated(spark, (20, 2), (21, 2), (9, 4)), folder, date(2024, 1, 2), date(2024, 1, 3))
    assert done == (2, 1)  # day 4 is not of the range; day 3 has no rows any more
    assert content(spark, folder) == [(1, 1), (20, 2), (21, 2), (4, 4)]
    assert (names(folder, 1), names(folder, 4)) == kept
    assert replace_days(dated(spark, (20, 2), (21, 2)), folder, date(2024, 1, 2), date(2024, 1, 3)) == (2, 0)


def test_a_failed_run_changes_nothing(spark, folder):
    replace_days(dated(spark, (1, 1), (2, 2)), folder, *JANUARY)
    bad = dated(spark, (5, 1), (6, 2)).selectExpr("a div (a - 6) AS a", "year", "month", "day")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        replace_days(bad, folder, *JANUARY)
    assert content(spark, folder) == [(1, 1), (2, 2)]


@pytest.mark.parametrize("style", ["plain", "hive"])
def test_replay(spark, folder, style):
    from starmart.sources import date_prefix

    raw, staged = f"{folder}/raw/1999/12/31", f"{folder}/staged"
    for d in (1, 2, 12):
        path = date_prefix(raw, date(2024, 1, d), style)
        spark.createDataFrame([(d,)], "a int").coalesce(1).write.json(path)
    assert replay_days(spark, raw, staged, *JANUARY, SPEC, style) == (3, 0)
    assert content(spark, staged) == [(1, 1), (12, 12), (2, 2)]
    assert replay_days(spark, raw, staged, date(2024, 1, 12), date(2024, 1, 13), SPEC, style) == (1, 0)
    nothing = read_days(spark, raw, date(2023, 1, 1), date(2023, 1, 2), SPEC, style)
    assert nothing.count() == 0 and nothing.columns == ["a", "year", "month", "day"]
    with pytest.raises(ValueError):
        replay_days(spark, raw, staged, date(2024, 1, 2), date(2024, 1, 1), SPEC)
