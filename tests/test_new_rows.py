"""The key filter, the bucketed target, the match within a tolerance, and reserved ids."""

import math
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from starmart import files
from starmart.operators import add_reserved_id, anti_new, enrich_near, near_match, reserve
from starmart.schemas import table
from starmart.sinks import add_keys, append_bucketed, filtered_anti_new, load_fact, new_for_bucketed, read_sketch, read_target
from starmart.sinks import key_filter

NAN, INF = math.nan, math.inf


def test_filter_gives_the_rows_of_the_anti_join(spark, folder):
    draw = random.Random(1)
    made = [(draw.choice("abcd"), draw.randint(0, 3000)) for _ in range(4000)]
    target = spark.createDataFrame(made[:2000], "s string, n int")
    batch = spark.createDataFrame(made[1000:] + [(None, 1), ("a", None)], "s string, n int")
    for part in (F.col("n") % 2 == 0, F.col("n") % 2 == 1):
        add_keys(target.filter(part), folder, ["s", "n"], expected_keys=4000)
    want = rows(anti_new(batch, target, ["s", "n"]))
    assert rows(filtered_anti_new(batch, target, ["s", "n"], folder)) == want
    key_filter.compact(spark, folder)
    assert len(list(files.files_below(spark, folder))) >= 1
    assert rows(filtered_anti_new(batch, target, ["s", "n"], folder)) == want


@pytest.mark.parametrize("expected", [10, 5000])
def test_no_known_key_is_missed_and_few_new_ones_look_known(spark, folder, expected):
    known = spark.range(0, 5000)
    add_keys(known, folder, ["id"], expected)
    slots = key_filter.sketch_slots(spark, folder)
    marked = key_filter.mark_known(spark.range(0, 25000), read_sketch(spark, folder), ["id"], slots, "known")
    counted = {r["old"]: r["n"] for r in marked.filter("known").groupBy((F.col("id") < 5000).alias("old")).agg(F.count("*").alias("n")).collect()}
    assert counted[True] == 5000
    if expected == 5000:
        assert counted.get(False, 0) < 20000 / key_filter.BITS_PER_KEY * 1.3


def test_a_batch_of_new_keys_does_not_read_the_target(spark, folder):
    target = spark.range(0, 1000)
    target.write.parquet(f"{folder}/target")
    target = spark.read.parquet(f"{folder}/target")
    add_keys(target, f"{folder}/sketch", ["id"], 100_000)
    batch = spark.range(10**9, 10**9 + 20)
    fresh = filtered_anti_new(batch, target, ["id"], f"{folder}/sketch")
    assert fresh.count() == 20
    assert not [f for f in fresh.inputFiles() if "/target/" in f] and "Join" not in plan(fresh)
    # Without a sketch no key is known; an empty target keeps null keys.
    assert filtered_anti_new(batch, target.limit(0), ["id"], f"{folder}/none").count() == 20
    nulls = spark.createDataFrame([(None,), (1,)], "id bigint")
    assert rows(filtered_anti_new(nulls, target.filter("id < 0"), ["id"], f"{folder}/none")) == [(1,), (None,)]
    assert rows(filtered_anti_new(nulls, target, ["id"], f"{folder}/sketch")) == []


def test_a_bucketed_target_is_not_shuffled(spark, folder, database, conf):
    spec = table("t", "id bigint, v string", pk="id")
    name = f"{database}.known"
    old = spark.range(0, 900).selectExpr("id", "cast(id as string) v")
    append_bucketed(old.filter("id < 500"), spec, ["id"], 4, name)
    append_bucketed(old.filter("id >= 500"), spec, ["id"], 4, name)
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="4")
    batch = spark.range(800, 1000)
    fresh = new_for_bucketed(batch, name, ["id"])
    text = plan(fresh).split("Subquery")[0]
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in text
    assert rows(fresh) == [(i,) for i in range(900, 1000)]
    with pytest.raises(ValueError, match="other types"):
        new_for_bucketed(batch.selectExpr("cast(id as int) id"), name, ["id"])


@pytest.mark.parametrize("salts", [0, 4])
@pytest.mark.parametrize("tolerance", [0.1, 1.0, 1e-9, 1e12])
def test_tolerance_like_a_nested_loop(spark, salts, tolerance):
    draw = random.Random(tolerance)
    values = [None, NAN, INF, -INF, 0.0, -0.0, 1e300, -1e300, 0.3, 0.1 + 0.2]
    values += [k * tolerance for k in (1, 2, 3, 1000, 1001)] + [draw.uniform(-4, 4) * tolerance for _ in range(30)]
    left = [(i, draw.choice(["a", "b", None]), v) for i, v in enumerate(values * 2)]
    right = [(f"r{i}", draw.choice(["a", "b", None]), v) for i, v in enumerate(values)]
    fact = spark.createDataFrame(left, "i int, k string, x double")
    dim = spark.createDataFrame(right, "name string, key string, y double")
    got = enrich_near(fact, dim, {"k": "key"}, ("x", "y"), tolerance, ["name"], salts, 0.01)
    want = []
    for i, k, x in left:
        met = [n for n, key, y in right if k is not None and k == key and x is not None and y is not None and abs(x - y) <= tolerance]
        want += [(i, k, x, n) for n in met or [None]]
    assert [repr(r) for r in rows(got)] == sorted(repr(r) for r in want)


def test_numbers_two_tolerances_apart_seldom_meet(spark):
    """On a grid that wide a number is compared with one neighbour at most, not with both."""
    grid = spark.range(2_000).selectExpr("900.0d + id / 10.0d x")
    bins = grid.select("x", F.explode(near_match._reached(F.col("x"), 0.05)).alias("b"))
    own = grid.select(F.col("x").alias("y"), near_match._bin(F.col("x"), 0.05).alias("b"))
    met = bins.join(own, "b")
    assert met.filter("x = y").count() == 2_000 and met.count() <= 4_000
    far = spark.sql("select 1d * (1L << 45) x union all select 1e308d union all select double('nan') union all select null")
    sizes = far.select(F.size(near_match._reached(F.col("x"), 1.0)).alias("n"))
    assert [r["n"] for r in sizes.collect()] == [5] * 4


def test_tolerance_plan_and_arguments(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.createDataFrame([("a", 1.0)], "k string, x double")
    text = plan(enrich_near(df, df.toDF("key", "y"), {"k": "key"}, ("x", "y"), 0.5, ["y"]))
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
    with pytest.raises(ValueError):
        enrich_near(df, df, {"k": "k"}, ("x", "x"), 0, ["x"])


def test_blocks_are_taken_once(spark, folder):
    with ThreadPoolExecutor(8) as pool:
        found = [b for blocks in pool.map(lambda n: reserve(spark, folder, n * 10, 10), [1, 2, 3, 1, 0, 2, 5, 1]) for b in blocks]
    assert sorted(found) == list(range(15))
    with pytest.raises(ValueError, match="another size"):
        reserve(spark, folder, 1, 20)


def test_reserved_ids_skip_what_others_took(spark, folder):
    for taken in (1, 2, 5):
        files.create_new(spark, f"{folder}/block-{taken:012d}")
    files.create_new(spark, f"{folder}/size-10")
    df = spark.range(0, 45, 1, 3).withColumnRenamed("id", "n")
    got = add_reserved_id(df, folder, block_size=10)
    ids = sorted(r["id"] for r in got.collect())
    # Blocks after the last known one, without a gap between them.
    assert ids == list(range(61, 106))
    assert add_reserved_id(df.limit(0), folder, block_size=10).count() == 0


def test_thousands_of_blocks_taken_in_turns(spark, folder, monkeypatch):
    mine = list(range(0, 12_000, 2))
    monkeypatch.setattr("starmart.operators.id_ranges.reserve", lambda spark, ledger, rows, size: mine)
    got = add_reserved_id(spark.range(60_000).withColumnRenamed("id", "n"), folder, block_size=10)
    assert len(got._jdf.queryExecution().analyzed().toString()) < 100_000
    wanted = spark.range(60_000).selectExpr("20 * (id div 10) + id % 10 + 1 id")
    assert got.select("id").exceptAll(wanted).count() == 0 and got.distinct().count() == 60_000


def test_interleaved_loads(spark, folder):
    spec = table("f", "id bigint, t int", pk="id", not_null="t")
    read_target(spark, f"{folder}/fact", spec)
    batches = [spark.range(k * 100, k * 100 + 37).selectExpr("cast(id as int) t") for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda b: load_fact(b, f"{folder}/fact", spec, ["t"], "reserved", id_ledger=f"{folder}/ids", id_block=10), batches))
    got = read_target(spark, f"{folder}/fact", spec)
    assert [d.inserted for d in done] == [37] * 4 and got.count() == 148 and got.select("id").distinct().count() == 148
    with pytest.raises(ValueError, match="id_ledger"):
        load_fact(batches[0].selectExpr("t + 1000 t"), f"{folder}/fact", spec, ["t"], "reserved")
