from datetime import datetime

from pyspark.sql import functions as F

from starmart.functions import (
    calendar_parts,
    compose_key,
    epoch_ms_to_ts,
    hash_key,
    is_missing,
    time_key,
    ts_to_epoch_ms,
    ts_to_epoch_seconds,
)
from starmart.functions.textkeys import TIME_KEY_12H
from conftest import rows


def epoch(spark, *ms):
    return spark.createDataFrame([(m,) for m in ms], "ts bigint")


def test_milliseconds_are_cut_to_the_second(spark):
    df = epoch(spark, 1_541_121_934_000, 1_541_121_934_999, 1_541_121_935_000, None)
    out = [r[0] for r in df.select(epoch_ms_to_ts("ts")).collect()]
    assert out == [
        datetime(2018, 11, 2, 1, 25, 34),
        datetime(2018, 11, 2, 1, 25, 34),
        datetime(2018, 11, 2, 1, 25, 35),
        None,
    ]


def test_milliseconds_can_be_kept(spark):
    (out,) = epoch(spark, 1_541_121_934_796).select(epoch_ms_to_ts("ts", "ms")).first()
    assert out == datetime(2018, 11, 2, 1, 25, 34, 796000)


def test_times_do_not_depend_on_the_session_zone(spark, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    df = epoch(spark, 1_541_121_934_796).select(epoch_ms_to_ts("ts", "ms").alias("t"))
    (row,) = calendar_parts(df, "t", ("hour", "day")).withColumns(
        {"ms": ts_to_epoch_ms("t"), "s": ts_to_epoch_seconds("t")}
    ).collect()
    assert (row.hour, row.day, row.ms, row.s) == (1, 2, 1_541_121_934_796, 1_541_121_934)


def test_calendar_parts_at_a_sunday_and_in_iso_week_one(spark):
    df = spark.createDataFrame(
        [(datetime(2018, 11, 4, 13, 5),), (datetime(2018, 12, 31),)], "t timestamp_ntz"
    )
    iso = calendar_parts(df, "t").drop("t").collect()
    assert tuple(iso[0]) == (13, 4, 44, 11, 2018, 7)
    assert tuple(iso[1]) == (0, 31, 1, 12, 2018, 1)
    sun0 = calendar_parts(df, "t", ["weekday"], weekday="sun0").collect()
    assert [r.weekday for r in sun0] == [0, 1]


def test_twelve_hour_key_confuses_morning_and_afternoon(spark):
    df = spark.createDataFrame(
        [(datetime(2018, 11, 4, 1),), (datetime(2018, 11, 4, 13),)], "t timestamp_ntz"
    )
    assert df.select(time_key("t", TIME_KEY_12H)).distinct().count() == 1
    assert df.select(time_key("t")).distinct().count() == 2


def test_composed_key_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "s string, n int")
    assert rows(df.select(compose_key(["s", "n"]))) == [("a1",), (None,)]
    assert rows(df.select(compose_key(["s", "n"], "|"))) == [("a|1",), (None,)]


def test_hash_tells_nulls_in_different_columns_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "x string, y string")
    assert df.select(hash_key(["x", "y"])).distinct().count() == 4


def test_missing_is_null_or_blank(spark):
    df = spark.createDataFrame([("",), (None,), (" ",), ("x",)], "s string")
    assert [r[0] for r in df.select(is_missing("s")).collect()] == [True, True, False, False]
    assert not spark.range(1).select(is_missing(F.col("id"))).first()[0]
