import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart.schemas import DIM_USERS, FACT_SONGPLAYS, LAKE_SONGS, LAKE_SONGS_BY_ARTIST, table
from starmart.session import CLEANUP_CONF, dropping_shuffles, work_dir
from starmart.sinks import (
    append,
    drop_table,
    ensure_table,
    has_rows,
    load_dimension,
    load_fact,
    load_new,
    publish,
    read_target,
    table_location,
    upsert_dimension,
    write_parquet,
)
from conftest import plan, rows

ITEMS = table("items", "k int, v string, p int", pk="k", partition_by="p")


def items(spark, *keys):
    return spark.createDataFrame([(k, f"v{k}", k % 3) for k in keys], "k int, v string, p int")


def test_load_new_is_idempotent_and_counts(spark, folder):
    assert load_new(items(spark, 1, 2, 3), folder, ITEMS, count_skipped=True) == (3, 0)
    assert load_new(items(spark, 2, 3, 4), folder, ITEMS, count_skipped=True) == (1, 2)
    assert load_new(items(spark, 2, 3, 4), folder, ITEMS) == (0, None)
    assert [r.k for r in read_target(spark, folder, ITEMS).orderBy("k").collect()] == [1, 2, 3, 4]


def test_null_keys_enter_an_empty_target_only(spark, folder):
    batch = spark.createDataFrame([(1, "a", 0), (None, "b", 0)], "k int, v string, p int")
    assert load_new(batch, folder, ITEMS).inserted == 2
    more = spark.createDataFrame([(2, "a", 0), (None, "c", 0)], "k int, v string, p int")
    assert load_new(more, folder, ITEMS).inserted == 1


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 60), min_size=1, max_size=60, unique=True), st.integers(2, 4), st.randoms())
def test_any_split_of_a_batch_loads_the_same_keys(spark, keys, parts, rng):
    path = work_dir(spark, "split")
    chunks = [[] for _ in range(parts)]
    for key in keys:
        for chunk in rng.sample(chunks, 2):  # every key arrives twice
            chunk.append(key)
    total = sum(load_new(items(spark, *c), path, ITEMS).inserted for c in chunks if c)
    assert total == len(keys)
    assert sorted(r.k for r in read_target(spark, path, ITEMS).collect()) == sorted(keys)


PLAYS = (
    "start_time string, user_id int, level string, song_id string, artist_id string, "
    "session_id int, location string, user_agent string"
)
KEY = ("start_time", "user_id")


def play(time, user=1, song="s"):
    return (time, user, "free", song, "a", 1, "x", "y")


def test_fact_load_sees_morning_and_afternoon_and_batch_duplicates(spark, folder):
    def frame(*data):
        start = F.col("start_time").cast("timestamp_ntz")
        return spark.createDataFrame(data, PLAYS).withColumn("start_time", start)

    morning, noon = play("2018-11-04 01:00:00"), play("2018-11-04 13:00:00")
    assert load_fact(frame(morning), folder, FACT_SONGPLAYS, KEY).inserted == 1
    assert load_fact(frame(morning, noon), folder, FACT_SONGPLAYS, KEY).inserted == 1
    twice = [play("2018-11-05 01:00:00", song="t"), play("2018-11-05 01:00:00", song="u")]
    other = work_dir(spark, "fact")
    assert load_fact(frame(*twice), other, FACT_SONGPLAYS, KEY, dedup_batch=True).inserted == 1
    assert load_fact(frame(*twice), folder, FACT_SONGPLAYS, KEY).inserted == 2
    stored = read_target(spark, folder, FACT_SONGPLAYS)
    assert stored.columns == FACT_SONGPLAYS.columns
    assert stored.select("id").distinct().count() == 4
    numbered = work_dir(spark, "fact")
    load_fact(frame(morning, noon), numbered, FACT_SONGPLAYS, KEY, id_kind="sequence", id_start=7)
    assert rows(read_target(spark, numbered, FACT_SONGPLAYS).select("id")) == [(7,), (8,)]


def test_missing_partition_values_get_a_folder_of_their_own(spark, folder):
    songs = spark.createDataFrame(
        [("s1", "t", "a1", "2000", 1.0), ("s2", "t", "a1", "XXXX", 1.0), ("s3", "t", "a2", "0", 1.0)],
        "song_id string, title string, artist_id string, year string, duration double",
    )
    for spec in (LAKE_SONGS, LAKE_SONGS_BY_ARTIST):
        path = work_dir(spark, "songs")
        assert append(songs, path, spec) == 3
        back = read_target(spark, path, spec)
        assert rows(back.select("song_id", "year")) == [("s1", "2000"), ("s2", "XXXX"), ("s3", "0")]
        one = back.filter("year = 'XXXX'")
        assert [r.song_id for r in one.collect()] == ["s2"]
        assert "PartitionFilters: [isnotnull(year" in plan(one)
        assert "/year=XXXX/" in one.select("_metadata.file_path").first()[0]


def test_a_partitioned_write_splits_a_hot_folder(spark, folder, conf):
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200000",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )
    df = spark.range(0, 60000, 1, 8).selectExpr("id", "sha1(cast(id as string)) s", "case when id % 3 = 0 then id % 50 else 0 end p")
    assert write_parquet(df, folder, ["p"], partitions=64) == 60000
    back = spark.read.parquet(folder)
    assert back.count() == 60000
    hot = [f for f in back.inputFiles() if "/p=0/" in f]
    assert len(hot) == 8  # the folder is split by map task, of which there are eight
    per_folder = [sum(f"/p={p}/" in f for f in back.inputFiles()) for p in range(1, 50)]
    # Only folders that hash to the hot folder's shuffle partition are cut with it.
    assert sum(n == 1 for n in per_folder) >= 45 and set(per_folder) <= {1, 8}


def test_overwrite_and_emptiness(spark, folder):
    write_parquet(items(spark, 1, 2), folder)
    assert write_parquet(items(spark, 3), folder, mode="overwrite") == 1
    assert rows(spark.read.parquet(folder).select("k")) == [(3,)]
    assert has_rows(items(spark, 1)) and not has_rows(items(spark, 1).limit(0))


def users(spark, *data):
    return spark.createDataFrame([(i, "f", "l", "g", level) for i, level in data], DIM_USERS.schema)


def test_dimension_refresh_append_and_upsert(spark, folder, database):
    name = f"{database}.dim_users"
    ensure_table(spark, DIM_USERS, folder, name)
    ensure_table(spark, DIM_USERS, folder, name)
    assert spark.table(name).count() == 0

    def levels():
        return rows(spark.table(name).select("id", "level"))

    assert load_dimension(users(spark, (1, "free"), (2, "free")), DIM_USERS, folder, name=name).inserted == 2
    old = table_location(spark, name)
    assert load_dimension(users(spark, (2, "paid"), (3, "free")), DIM_USERS, folder, append=True, name=name).inserted == 1
    assert levels() == [(1, "free"), (2, "free"), (3, "free")] and table_location(spark, name) == old
    assert upsert_dimension(users(spark, (2, "paid"), (4, "paid")), DIM_USERS, folder, name=name) == 4
    assert levels() == [(1, "free"), (2, "paid"), (3, "free"), (4, "paid")]
    assert table_location(spark, name) != old
    assert read_target(spark, old, DIM_USERS).count() == 3  # earlier readers keep their version
    assert load_dimension(users(spark, (9, "free")), DIM_USERS, folder, name=name).inserted == 1
    assert levels() == [(9, "free")]
    drop_table(spark, name)
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_publish_refuses_partitioned_tables(spark, folder):
    with pytest.raises(ValueError, match="partitioned"):
        publish(items(spark, 1), ITEMS, folder)


def test_loads_do_not_depend_on_row_order(spark, folder):
    keys = list(range(50))
    random.Random(1).shuffle(keys)
    load_new(items(spark, *keys).repartition(7), folder, ITEMS)
    assert load_new(items(spark, *sorted(keys)), folder, ITEMS).inserted == 0



def test_an_empty_load_leaves_no_file(spark, folder):
    spec = table("t", "id int, v int", pk="id")
    batch = spark.createDataFrame([(1, 1)], "id int, v int")
    load_new(batch, folder, spec)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    before = rows(listed.select("path"))
    for _ in range(3):
        assert load_new(batch, folder, spec).inserted == 0
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    assert rows(listed.select("path")) == before


def test_ids_go_on_over_loads_and_copies_get_their_own(spark, folder):
    spec = table("f", "id bigint, t int, v string", pk="id", not_null="t")
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "t int, v string")
    second = spark.createDataFrame([(2, "x"), (3, "b"), (4, "c")], "t int, v string")
    for batch in (first, second):
        load_fact(batch, folder, spec, ["t"], "sequence")
    assert sorted(r["id"] for r in read_target(spark, folder, spec).collect()) == [1, 2, 3, 4, 5]
    hashed = f"{folder}-hash"
    load_fact(first, hashed, spec, ["t"])
    got = read_target(spark, hashed, spec)
    assert got.count() == 3 and got.select("id").distinct().count() == 3
    with pytest.raises(ValueError, match="may be null"):
        load_fact(first, hashed, spec, ["t", "v"])


def test_rows_with_copies_are_shuffled_once(spark, folder, conf, monkeypatch):
    from starmart.sinks import loads

    conf(**{"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1"})
    spec = table("f", "id bigint, t int, v string", pk="id", not_null="t")
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "t int, v string")
    plans, write = [], loads.write_observed

    def watched(rows, path, *args, **options):
        if not path.endswith("/batch"):
            plans.append(plan(rows))
        return write(rows, path, *args, **options)

    monkeypatch.setattr(loads, "write_observed", watched)
    load_fact(batch, folder, spec, ["t"])
    # The rows, the hashes that occur twice and the target's keys are dealt once each, though read twice.
    assert plans[0].count("ReusedExchange") == 3
    assert read_target(spark, folder, spec).select("id").distinct().count() == 5


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    sizes = {f.getName(): f.length() for f in map(found.apply, range(found.size()))}
    # The one row of an EXISTS is left to the driver's garbage collection.
    return {n for n, size in sizes.items() if n.startswith("shuffle_") and n.endswith(".data") and size > 200}


def left_over(spark, before):
    """Shuffle files that are still there after a while; Spark deletes them beside the work."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_a_load_leaves_no_shuffle_files(spark, folder, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spec = table("plays", "id bigint, start_time timestamp, k int, v string", pk="id", not_null="start_time k", sort_by="start_time")
    batch = spark.range(1000).selectExpr("cast(id % 500 as int) k", "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 500) start_time", "'x' v")
    spark._jvm.System.gc()
    time.sleep(0.5)
    before = shuffle_files(spark)
    for inserted in (1000, 0):
        done = load_fact(batch.repartition(3), f"{folder}/plays", spec, ["start_time", "k"], prune_by=["start_time"])
        assert done.inserted == inserted
    write_parquet(batch.groupBy("k").count(), f"{folder}/counts")
    assert not left_over(spark, before)
    assert spark.conf.get(CLEANUP_CONF) == "false"


def test_the_own_setting_comes_back_with_the_last_user(spark):
    with pytest.raises(KeyError), dropping_shuffles(spark):
        with dropping_shuffles(spark):
            pass
        assert spark.conf.get(CLEANUP_CONF) == "true"
        raise KeyError
    assert spark.conf.get(CLEANUP_CONF) == "false"
