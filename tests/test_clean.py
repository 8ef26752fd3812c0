from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException

from starmart.operators import conform, impute_missing, require_finite, require_present
from starmart.schemas import DIM_SONGS_WHOLE, DIM_TIME, DIM_TIME_TEXT, DIM_USERS
from conftest import rows

NAN = float("nan")


@pytest.fixture
def log_missing(spark):
    return spark.createDataFrame(
        [(None, 1, 1.0), ("", 2, 2.0), ("8", None, 3.0), ("x", 4, NAN), ("9", 5, None)],
        "userId string, ts bigint, length double",
    )


def test_present_drops_null_and_blank(log_missing):
    kept = require_present(log_missing, ["userId"]).select("userId")
    assert rows(kept) == [("8",), ("9",), ("x",)]


def test_present_can_let_blanks_through(log_missing):
    kept = require_present(log_missing, ["userId", "ts"], blank_ok=True).select("userId")
    assert rows(kept) == [("",), ("9",), ("x",)]


def test_finite_drops_null_and_nan(log_missing):
    kept = require_finite(log_missing, ["ts", "length"]).select("userId")
    assert rows(kept) == [("",), (None,)]


def test_imputation_makes_text(spark):
    df = spark.createDataFrame([(None, "a"), (0, ""), (2000, None)], "year int, artist_id string")
    out = impute_missing(df, ["year", "artist_id"], "XXXX")
    assert rows(out) == [("0", "XXXX"), ("2000", "XXXX"), ("XXXX", "a")]
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "string"]


def test_conform_renames_casts_and_reorders(spark):
    df = spark.createDataFrame(
        [("8", "F", "Ann", "paid", "Lee"), ("x", "M", "Bob", "free", "Ray"), ("", None, None, None, None)],
        "userId string, gender string, firstName string, level string, lastName string",
    )
    out = conform(df, DIM_USERS, {"id": "userId", "first_name": "firstName", "last_name": "lastName"})
    assert out.columns == DIM_USERS.columns
    assert rows(out) == [
        (8, "Ann", "Lee", "F", "paid"),
        (None, "Bob", "Ray", "M", "free"),
        (None, None, None, None, None),
    ]


def test_whole_numbers_round_half_up(spark):
    df = spark.createDataFrame(
        [("a", "t", "r", 1, 2.5), ("b", "t", "r", 1, -2.5), ("c", "t", "r", 1, 218.93179)],
        "id string, title string, artist_id string, year int, duration double",
    )
    out = conform(df, DIM_SONGS_WHOLE).select("duration")
    assert [r[0] for r in out.collect()] == [Decimal(3), Decimal(-3), Decimal(219)]


def test_a_number_out_of_range_fails(spark):
    df = spark.range(1).selectExpr(
        "timestamp_ntz'2020-01-01' start_time", "3000000000L hour", "1 day", "1 week", "1 month", "1 year", "1 weekday"
    )
    with pytest.raises(ArithmeticException):
        conform(df, DIM_TIME).collect()


def test_retyped_table_stores_calendar_parts_as_text():
    types = {f.name: f.dataType.simpleString() for f in DIM_TIME_TEXT.schema}
    assert types["month"] == types["weekday"] == "string" and types["day"] == "int"
    with pytest.raises(ValueError):
        DIM_TIME.retyped(quarter="int")
