import pytest
from pyspark.sql import functions as F

from starmart.operators import anti_new, enrich, hot_keys
from conftest import plan, rows

NAN = float("nan")
ON = {"artist": "artist_name", "song": "title", "length": "duration"}


@pytest.fixture
def catalogue(spark):
    return spark.createDataFrame(
        [("s1", "A", "x", 10.0), ("s2", "A", "y", 0.0), ("s3", "B", "z", NAN), ("s4", None, "x", 10.0), ("s5", "C", "w", 7.4)],
        "song_id string, artist_name string, title string, duration double",
    )


@pytest.fixture
def log_match(spark):
    return spark.createDataFrame(
        [(1, "A", "x", 10.0), (2, "A", "x", 10.5), (3, None, "x", 10.0), (4, "A", "y", -0.0), (5, "B", "z", NAN), (6, "C", "w", 6.6)],
        "n int, artist string, song string, length double",
    )


def test_exact_match_keeps_all_plays(log_match, catalogue):
    out = enrich(log_match, catalogue, ON, ["song_id"]).select("n", "song_id")
    assert rows(out) == [(1, "s1"), (2, None), (3, None), (4, "s2"), (5, "s3"), (6, None)]


def test_rounded_match(log_match, catalogue):
    whole = enrich(log_match.filter("n <> 5"), catalogue.filter("song_id <> 's3'"), ON, ["song_id"], round_to={"length": 0})
    assert rows(whole.select("n", "song_id")) == [(1, "s1"), (2, None), (3, None), (4, "s2"), (6, "s5")]


def test_fanout(spark, log_match, catalogue):
    double = catalogue.unionByName(catalogue.filter("song_id = 's1'").withColumn("song_id", F.lit("s0")))
    assert rows(enrich(log_match, double, ON, ["song_id"]).filter("n = 1").select("song_id")) == [("s0",), ("s1",)]
    first = enrich(log_match, double, ON, ["song_id"], fanout="first")
    assert rows(first.filter("n = 1").select("song_id")) == [("s0",)]
    with pytest.raises(Exception, match="several dimension rows"):
        enrich(log_match, double, ON, ["song_id"], fanout="error").collect()
    assert enrich(log_match, catalogue, ON, ["song_id"], fanout="error").count() == 6
    with pytest.raises(ValueError):
        enrich(log_match, catalogue, ON, ["song_id"], fanout="some")


def skewed(spark):
    """A third of the rows on one key, a tenth without a key."""
    return spark.range(6000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else cast(id % 500 as string) end k"
    )


def test_hot_keys_are_few_and_exact(spark):
    assert rows(hot_keys(skewed(spark), ["k"], 0.1)) == [("hot",)]


def test_salted_join_equals_plain_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    dim = spark.range(400).selectExpr("cast(id as string) k2", "id v").union(
        spark.range(2).selectExpr("'hot'", "id + 9000")
    )
    fact = skewed(spark)
    plain = enrich(fact, dim, {"k": "k2"}, ["v"])
    salted = enrich(fact, dim, {"k": "k2"}, ["v"], salts=8, hot_share=0.1)
    assert rows(plain) == rows(salted)
    assert plain.count() == 6000 + 2000  # every hot row matches twice


def test_adaptive_execution_splits_a_hot_join_partition(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4000",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1000",
    )
    dim = spark.range(400).selectExpr("cast(id as string) k2", "id v").union(spark.sql("select 'hot', 1L"))
    joined = enrich(skewed(spark).repartition(8), dim, {"k": "k2"}, ["v"])
    joined.collect()
    assert "skew=true" in plan(joined)


def test_anti_new_follows_not_in(spark):
    batch = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    target = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(anti_new(batch, target, "k")) == [(1,)]
    assert rows(anti_new(batch, target.limit(0), "k")) == [(1,), (2,), (None,)]


def test_anti_new_with_two_columns(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, None)], "k int, u string")
    target = spark.createDataFrame([(1, "a")], "k int, u string")
    assert rows(anti_new(batch, target, ["k", "u"])) == [(1, "b")]


def test_anti_new_is_disjoint_from_the_target_and_inside_the_batch(spark):
    batch, target = spark.range(0, 1000), spark.range(500, 3000)
    out = anti_new(batch, target, "id")
    assert out.count() == 500 and out.join(target, "id").count() == 0


def test_anti_new_does_not_force_a_broadcast(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(anti_new(spark.range(10), spark.range(5), "id"))
    assert "SortMergeJoin" in text and "LeftAnti" in text
    assert "BroadcastHashJoin" not in text and "NestedLoop" not in text


def test_pruned_anti_join_reads_only_the_partitions_of_the_batch(spark, folder):
    days = spark.range(0, 48).selectExpr("cast(id as int) id", "cast(2000 + id div 12 as int) year", "cast(1 + id % 12 as int) month")
    days.filter("id % 2 = 0").write.partitionBy("year", "month").parquet(folder)
    target = spark.read.parquet(folder)
    batch = days.filter("id between 20 and 30").unionByName(spark.sql("select cast(null as int) id, cast(null as int) year, cast(null as int) month"))
    pruned = anti_new(batch, target, ["id"], prune_by=["year", "month"])
    assert rows(pruned) == rows(anti_new(batch, target, ["id"]))
    assert [r.id for r in pruned.orderBy("id").collect()] == [21, 23, 25, 27, 29]
    scans = [line for line in plan(pruned).splitlines() if "FileScan" in line and "PartitionFilters: [isnotnull" in line]
    assert scans and "(year#" in scans[0] and ">= 2001" in scans[0] and "<= 2002" in scans[0]


def test_pruned_anti_join_skips_row_groups(spark, folder):
    spark.range(0, 100000, 1, 20).selectExpr("id", "id * 2 v").write.parquet(folder)
    target = spark.read.parquet(folder)
    batch = spark.range(4990, 5010, 1, 2).unionByName(spark.range(120000, 120001, 1, 1)).filter("id < 100000")
    assert anti_new(batch, target, "id", prune_by=["id"]).count() == 0
    narrow = anti_new(batch, target, ["id"], prune_by=["id"])
    narrow.collect()
    # 20 files of 5000 rows; the batch touches two of them, the emptiness test reads one row.
    read = max(rows_read(narrow))
    assert read <= 10000


def rows_read(df):
    """Output rows of every file scan in the executed plan."""
    found = []

    def walk(node):
        if "FileScan" in node.nodeName() or node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        for child in (node.children(), node.subqueries()):
            for i in range(child.size()):
                walk(child.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            walk(node.plan())
        if node.nodeName() == "Subquery":
            walk(node.child())

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_null_safe_keys_count_as_values(spark, folder):
    batch = spark.createDataFrame([(1, None), (1, "a"), (None, None), (2, None)], "t int, s string")
    target = spark.createDataFrame([(1, None), (None, None)], "t int, s string")
    assert rows(anti_new(batch, target, ["t", "s"], nulls="equal")) == [(1, "a"), (2, None)]
    assert rows(anti_new(batch, target, ["t", "s"])) == [(1, "a")]
    for prune in (["t"], ["t", "s"]):
        assert rows(anti_new(batch, target, ["t", "s"], prune, nulls="equal")) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        anti_new(batch, target, "t", nulls="other")


def test_repeated_target_keys_are_combined_before_their_shuffle(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    batch = spark.range(10).selectExpr("id AS k", "id AS v")
    target = spark.range(1000).selectExpr("id % 3 AS k")
    text = plan(anti_new(batch, target, "k"))
    assert "HashAggregate" in text and "SortMergeJoin" in text or "ShuffledHashJoin" in text
    assert "HashAggregate(keys=[k" in text
    assert rows(anti_new(batch, target, "k")) == [(i, i) for i in range(3, 10)]
    assert "HashAggregate(keys=[k" not in plan(anti_new(batch, target, "k", unique_target=True))


def test_null_safe_target_keys_are_dealt_once(spark, conf):
    """Combined keys lie where the join wants them: one shuffle of the target, one of the batch."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    batch = spark.createDataFrame([(1, None, NAN), (1, "a", 0.0), (None, None, 1.0), (2, None, -0.0)], "t int, s string, d double")
    target = spark.createDataFrame([(1, None, NAN), (2, None, 0.0), (2, None, 0.0)], "t int, s string, d double")
    assert rows(anti_new(batch, target, ["t", "s", "d"], nulls="equal").select("t", "s")) == [(1, "a"), (None, None)]
    fresh = anti_new(batch, target, ["t", "s"], nulls="equal")
    assert plan(fresh).count("Exchange hashpartitioning") == 2
    assert rows(fresh.select("t", "s")) == [(1, "a"), (None, None)]
    wider = target.withColumn("t", F.col("t").cast("bigint"))
    assert rows(anti_new(batch, wider, ["t", "s"], nulls="equal")) == rows(fresh)
