import pytest

from starmart.operators import add_id


def test_sequence_is_dense_from_its_start(spark):
    df = spark.range(1000).repartition(7)
    out = add_id(df.withColumnRenamed("id", "n"), "sequence", start=501)
    ids = sorted(r.id for r in out.collect())
    assert ids == list(range(501, 1501))


def test_sequence_can_follow_an_order(spark):
    df = spark.range(500).selectExpr("(id * 37) % 500 as n").repartition(5)
    out = add_id(df, "sequence", start=1, order_by=["n"]).collect()
    assert all(r.id == r.n + 1 for r in out)


def test_ordered_sequence_splits_equal_values(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")  # the test data is tiny
    hot = spark.range(0, 8000, 1, 8).selectExpr("case when id % 3 = 0 then 5 else id % 11 end as n")
    out = add_id(hot, "sequence", order_by=["n"])
    ids = [r.id for r in out.orderBy("n", "id").collect()]
    assert ids == list(range(1, 8001))
    written = spark.read.parquet(*set(out.inputFiles()))
    holding_the_hot_value = written.filter("n = 5").select("_metadata.file_name").distinct()
    assert holding_the_hot_value.count() > 1


def test_sequence_of_nothing(spark):
    assert add_id(spark.range(0).toDF("n"), "sequence").count() == 0


def test_hash_is_stable_and_monotonic_is_unique(spark):
    df = spark.range(100).selectExpr("id as n", "id % 5 as m")
    first = {r.n: r.id for r in add_id(df, "hash", cols=["n", "m"]).collect()}
    again = {r.n: r.id for r in add_id(df.repartition(3), "hash", cols=["n", "m"]).collect()}
    assert first == again and len(set(first.values())) == 100
    assert add_id(df.repartition(3), "monotonic", start=10).select("id").distinct().count() == 100


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        add_id(spark.range(1), "hash")
    with pytest.raises(ValueError):
        add_id(spark.range(1), "uuid")
