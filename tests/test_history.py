import random
from bisect import bisect_right
from datetime import datetime, timedelta

import pytest

from conftest import plan, rows
from starmart.operators import as_of, intervals
from starmart.sinks import read_history, update_history

START = datetime(2024, 1, 1)
SEEN = "u string, t timestamp_ntz, level string, plan int"


def at(hours):
    return START + timedelta(hours=hours)


def brute(made):
    moments = {}
    for u, t, level, number in made:
        if u is None or t is None:
            continue
        low = (level is None, level or "", number is None, number or 0)
        if (u, t) not in moments or low < moments[u, t][0]:
            moments[u, t] = (low, (level, number))
    out, last = [], {}
    for (u, t), (_, values) in sorted(moments.items()):
        if u in last and out[last[u]][1] == values:
            continue
        if u in last:
            out[last[u]][3] = t
        last[u] = len(out)
        out.append([u, values, t, None])
    return [(u, *v, a, b) for u, v, a, b in out], {k: v for k, (_, v) in moments.items()}


def made(seed, n=300):
    draw = random.Random(seed)
    return [
        (draw.choice(["a", "b", "c", None]), draw.choice([None, *[at(draw.randint(0, 2000) / 4)] * 9]), draw.choice(["free", "paid", None]), draw.choice([1, 1, None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seconds", [60, 86_400, 10**9])
def test_intervals(spark, seconds):
    data = made(seconds)
    got = intervals(spark.createDataFrame(data, SEEN), ["u"], "t", ["level", "plan"], seconds)
    assert rows(got) == sorted(brute(data)[0], key=repr)


def test_a_late_row_splits_an_interval(spark, folder):
    seen = [("a", at(0), "free", 1), ("a", at(48), "free", 1), ("a", at(72), "paid", 1)]
    late = [("a", at(24), "paid", 1), ("b", at(5), None, None)]
    for batch in (seen, late, late, seen):
        update_history(spark.createDataFrame(batch, SEEN), folder, ["u"], "t", ["level", "plan"], parts=3)
    want = [("free", at(0), at(24)), ("paid", at(24), at(48)), ("free", at(48), at(72)), ("paid", at(72), None)]
    assert rows(read_history(spark, folder).filter("u = 'a'").select("level", "valid_from", "valid_to")) == sorted(want, key=repr)


def test_any_order_of_arrival_gives_the_same_history(spark, folder):
    data = made(7)
    for k in range(2):
        random.Random(k).shuffle(data)
        for part in range(3):
            batch = spark.createDataFrame(data[part * 100 : part * 100 + 100], SEEN)
            update_history(batch, f"{folder}/{k}", ["u"], "t", ["level", "plan"], parts=2)
        assert rows(read_history(spark, f"{folder}/{k}")) == sorted(brute(data)[0], key=repr)


@pytest.mark.parametrize("seconds", [3600, 86_400, 10**9])
def test_as_of(spark, seconds):
    data, draw = made(11), random.Random(1)
    asked = [(i, draw.choice(["a", "b", "d", None]), draw.choice([None, *[at(draw.randint(-8, 2100) / 4)] * 9]), "own") for i in range(200)]
    fact = spark.createDataFrame(asked, "i int, u string, t timestamp_ntz, level string")
    seen = spark.createDataFrame(data, SEEN).withColumnRenamed("t", "seen_at")
    got = as_of(fact, seen, ["u"], "t", ["level", "plan"], "seen_at", seconds)
    moments = brute(data)[1]
    want = []
    for i, u, t, _ in asked:
        times = sorted(m for k, m in moments if k == u)
        found = bisect_right(times, t) if t is not None else 0
        want.append((i, u, t, *(moments[u, times[found - 1]] if found else (None, None))))
    assert got.columns == ["i", "u", "t", "level", "plan"] and rows(got) == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got)
