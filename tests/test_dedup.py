from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmart.operators import (
    dedup_by_key,
    distinct_rows,
    latest_by_time_join,
    latest_per_key,
    merge_latest,
)
from conftest import plan, rows

LOG = "user string, level string, ts bigint, page string"
LEVELS = [
    ("1", "free", 10, "p"),
    ("1", "paid", 20, "p"),
    ("2", "free", 20, "p"),
    ("3", "free", 30, "p"),
    ("3", "paid", 30, "p"),
    ("4", "paid", None, "p"),
    ("4", "free", 5, "p"),
]


def test_latest_level_wins_and_ties_are_settled(spark):
    log = spark.createDataFrame(LEVELS, LOG)
    expected = [("1", "paid"), ("2", "free"), ("3", "free"), ("4", "free")]
    for combine in (False, True):
        out = latest_per_key(log, ["user"], "ts", take=["level"], combine=combine)
        assert rows(out) == expected


def test_tie_breakers_take_the_highest(spark):
    log = spark.createDataFrame(LEVELS, LOG)
    out = latest_per_key(log, ["user"], "ts", tie_breakers=["level"]).filter("user = '3'")
    assert rows(out) == [("3", "paid", 30, "p")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.permutations(LEVELS * 2), st.integers(1, 5))
def test_latest_does_not_depend_on_row_order(spark, shuffled, parts):
    log = spark.createDataFrame(shuffled, LOG).repartition(parts)
    assert rows(latest_per_key(log, ["user"], "ts", take=["level"], combine=True)) == [
        ("1", "paid"), ("2", "free"), ("3", "free"), ("4", "free"),
    ]


def test_join_on_time_alone_mixes_users(spark):
    log = spark.createDataFrame(LEVELS, LOG)
    out = latest_by_time_join(log, "user", "ts", ["level"])
    assert rows(out) == [
        ("1", "free"), ("1", "paid"), ("2", "free"), ("2", "paid"), ("3", "free"), ("3", "paid"), ("4", "free"),
    ]


def test_distinct_keeps_several_rows_per_id_and_dedup_one(spark):
    songs = spark.createDataFrame(
        [("s1", "b", 1), ("s1", "a", 2), ("s1", "a", 2), ("s2", None, 3), ("s2", "z", 4)],
        "song_id string, title string, year int",
    )
    assert distinct_rows(songs).count() == 4
    assert rows(dedup_by_key(songs, ["song_id"])) == [("s1", "a", 2), ("s2", "z", 4)]
    assert rows(dedup_by_key(songs, ["song_id"], ["year"])) == [("s1", "b", 1), ("s2", None, 3)]
    assert rows(dedup_by_key(songs.select("song_id"), ["song_id"])) == [("s1",), ("s2",)]


def test_a_hot_key_is_cut_to_one_row_per_task_before_the_shuffle(spark):
    log = spark.createDataFrame(LEVELS, LOG)
    for df in (dedup_by_key(log, ["user"]), latest_per_key(log, ["user"], "ts")):
        text = plan(df)
        partial, shuffle = text.index("Partial"), text.index("Exchange hashpartitioning")
        assert "WindowGroupLimit" in text and partial > shuffle  # printed below = runs before


def test_merge_keeps_the_newer_row_and_adds_new_keys(spark):
    schema = "user string, level string, ts bigint"
    target = spark.createDataFrame([("1", "free", 10), ("2", "paid", 50), ("3", "free", 7)], schema)
    batch = spark.createDataFrame([("1", "paid", 20), ("2", "free", 40), ("3", "paid", 7), ("4", "free", 1)], schema)
    assert rows(merge_latest(target, batch, ["user"], "ts")) == [
        ("1", "paid", 20), ("2", "paid", 50), ("3", "paid", 7), ("4", "free", 1),
    ]


def test_merge_into_an_undated_target_lets_the_batch_win(spark):
    target = spark.createDataFrame([("1", "free"), ("2", "paid")], "user string, level string")
    batch = spark.createDataFrame(
        [("1", "free", 10), ("1", "paid", 20)], "user string, level string, ts bigint"
    )
    assert rows(merge_latest(target, batch, ["user"], "ts")) == [("1", "paid"), ("2", "paid")]
    single = batch.filter("ts = 20").drop("ts")
    assert rows(merge_latest(target, single, ["user"])) == [("1", "paid"), ("2", "paid")]
