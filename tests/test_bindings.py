import os

import pytest
from pyspark.sql import functions as F

from starmart import files
from starmart.plans import bindings, queries
from starmart.schemas import STAGING_EVENTS
from starmart.sources import read_json
from conftest import rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Ten customers with a hundred orders of four lines each; every part has a song of its own."""
    base = str(tmp_path_factory.mktemp("tables"))
    n = F.col("id")
    frames = {
        "nation": spark.range(2).select(n.alias("n_nationkey"), F.concat(F.lit("N"), n).alias("n_name"), F.lit(0).alias("n_regionkey")),
        "customer": spark.range(10).select(
            n.alias("c_custkey"), F.concat(F.lit("C"), n).alias("c_name"), (n % 2).alias("c_nationkey"),
            (n * 1.5).cast("double").alias("c_acctbal"), F.lit("FURNITURE").alias("c_mktsegment"),
        ),
        "part": spark.range(20).select(
            n.alias("p_partkey"), F.concat(F.lit("song "), n).alias("p_name"), F.concat(F.lit("B"), n % 3).alias("p_brand"),
            F.lit("T").alias("p_type"), (n % 5).cast("int").alias("p_size"), (n + 900.0).cast("double").alias("p_retailprice"),
        ),
        "orders": spark.range(100).select(
            n.alias("o_orderkey"), (n % 10).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
            F.expr("timestamp_ntz'1996-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("o_orderdate"),
            F.lit("5-LOW").alias("o_orderpriority"),
        ),
        "lineitem": spark.range(400).select(
            (n % 100).alias("l_orderkey"), (n % 20).alias("l_partkey"), (n % 7).alias("l_suppkey"),
            (n / 100 + 1).cast("int").alias("l_linenumber"), F.lit(30.0).alias("l_quantity"), (n / 8).cast("double").alias("l_extendedprice"),
            F.lit(0.0).alias("l_discount"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
            F.expr("timestamp_ntz'1996-02-01 00:00:00'").alias("l_shipdate"),
        ),
        "events": spark.range(120).select(
            n.alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 30 as int), 0, 0, id div 60)").alias("ts"),
            (n % 10).alias("user_id"), F.lit("view").alias("event_type"), F.lit(40.0).alias("value"), F.lit('{"k": 7}').alias("props"),
        ),
    }
    for name, df in frames.items():
        df.write.parquet(f"{base}/{name}.parquet")
    return base


def joins_above(df, column):
    """How many joins a row of the relation with ``column`` passes on its way up."""
    above, found = [], None
    for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
        name = line.lstrip(" :+-")
        depth = len(line) - len(name)
        above = [a for a in above if a[0] < depth]
        if name.startswith("Relation") and column in name:
            found = sum(a[1] for a in above)
        above.append((depth, name.startswith("Join")))
    return found


def test_lines_of_the_log_are_dealt_twice(spark, tables):
    log = bindings.log(spark, tables)
    assert joins_above(log, "l_orderkey") == joins_above(bindings.log(spark, tables, whole=True), "l_orderkey") == 2
    assert rows(log) == rows(bindings.log(spark, tables, whole=True))
    assert log.count() == 400 and log.columns == STAGING_EVENTS.columns


def test_raw_json_is_packed(spark, tables):
    path = queries._log_as_json(spark, tables)
    assert all(name.endswith(".json.gz") for name in files.names(spark, path))
    assert read_json(spark, path, STAGING_EVENTS, "fail").exceptAll(bindings.log(spark, tables)).count() == 0
    root = queries._raw_files(spark, tables)
    assert spark.read.schema(STAGING_EVENTS.schema).json(f"{root}/log-data/*/*/*.json").count() == 400


@pytest.mark.parametrize("n_batches", [2, 4])
def test_copies_lie_in_files_of_their_own_behind_the_rest(spark, tables, conf, n_batches):
    conf(**{"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1"})
    path = queries._log_with_copies(spark, tables, n_batches)
    # As many files as tasks have rows, however few batches there are.
    assert len(files.names(spark, path)) > 4
    named = spark.read.schema(STAGING_EVENTS.schema).json(path).withColumn("file", F.col("_metadata.file_name"))
    assert named.count() == 500
    second = named.filter("itemInSession = 2").groupBy(*STAGING_EVENTS.columns).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("n_files")
    )
    assert second.filter("n <> 2 or n_files <> 2").count() == 0
    age = {name: os.stat(f"{path.removeprefix('file:')}/{name}").st_mtime_ns for name in files.names(spark, path)}
    rest = {r[0] for r in named.filter("itemInSession <> 2").select("file").distinct().collect()}
    only_copies = set(age) - rest
    assert only_copies and max(age[f] for f in rest) < min(age[f] for f in only_copies)


def test_unknown_values_of_a_line_are_marked_as_before(spark, tables, tmp_path):
    lines = spark.read.parquet(f"{tables}/lineitem.parquet")
    n = F.col("l_partkey") % 4
    odd = lines.withColumns({
        "l_quantity": F.when(n == 0, 24.5).when(n == 1, 25.0).when(n == 2, float("nan")),
        "l_linestatus": F.when(n < 2, "O").when(n == 2, "F"),
        "l_returnflag": F.when(n == 1, "R").when(n < 3, "A"),
        "l_extendedprice": F.when(n < 3, F.col("l_extendedprice") + 0.126),
    })
    for name in ("nation", "customer", "part", "orders"):
        os.symlink(f"{tables}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    odd.write.parquet(f"{tmp_path}/lineitem.parquet")
    level, method = F.when(F.col("l_quantity") >= 25, "paid").otherwise("free"), F.when(F.col("l_linestatus") == "O", "PUT").otherwise("GET")
    page = F.when(F.col("l_returnflag") == "R", "Home").otherwise("NextSong")
    second = F.floor(F.col("l_extendedprice") * 100 + 0.5) % 1000
    wanted = odd.select(F.concat(F.lit("song "), "l_partkey"), level, method, page, second)
    got = bindings.log(spark, str(tmp_path)).select("song", "level", "method", "page", F.col("ts") % 1000)
    assert rows(got) == rows(wanted)


def test_the_log_is_joined_once_for_both_streams(spark, tables, monkeypatch):
    joined, raw, plain_log, plain_raw = [], [], queries.log, queries._log_with_copies
    monkeypatch.setattr(queries, "log", lambda *a, **b: joined.append(1) or plain_log(*a, **b))
    monkeypatch.setattr(queries, "_log_with_copies", lambda *a, **b: raw.append(plain_raw(*a, **b)) or raw[-1])
    assert queries.stream_fact_again(spark, tables).count() == 500
    # Each stream has files of its own, which are gone when it has read them.
    assert len(joined) == 1 and len(raw) == 2 and not [p for p in raw if files.exists(spark, p)]


def test_an_arrival_of_daily_visits_is_several_files(spark, tables, monkeypatch):
    monkeypatch.setattr(queries, "DAILY_FILE_ROWS", 25, raising=False)
    put = []
    monkeypatch.setattr(queries, "_put_json", lambda spark, rows, folder, n: put.append((folder, n)) or plain(spark, rows, folder, n))
    got = queries.stream_seconds_keyed(spark, tables)
    assert [n for _, n in put] == [5, 5, 5] and all(len(files.names(spark, f)) == 5 for f, _ in put)
    wanted = spark.read.parquet(f"{tables}/events.parquet").selectExpr("date_trunc('second', ts)", "string(user_id)").distinct()
    assert rows(got.select(F.col("start_time").cast("timestamp"), "userId")) == rows(wanted)


plain = queries._put_json
