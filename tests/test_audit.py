import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starmart.operators import QualityError
from starmart.schemas import DIM_USERS, table
from starmart.sinks import (
    Audit,
    ensure_table,
    load_dimension,
    load_fact,
    load_new,
    read_target,
    table_location,
    upsert_dimension,
)

ITEMS = table("items", "k int, v string, p int", pk="k", partition_by="p", not_null="v")


def items(spark, *made):
    return spark.createDataFrame([(k, v, p) for k, v, p in made], "k int, v string, p int")


def listing(path):
    return sorted(f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if not f.startswith((".", "_")))


@pytest.mark.parametrize(
    ("bad", "said"),
    [
        ([(2, "x", 1), (2, "y", 1)], r"repeated key \(2,\)"),
        ([(2, None, 1), (3, "y", 1)], "1 rows fail 'null v'"),
        ([(2, "x", -1)], "1 rows fail 'rule place'"),
        ([(2, "x", None)], "1 rows fail 'rule place'"),
    ],
)
@pytest.mark.parametrize("prune_by", [(), ("k",)])
def test_a_failing_batch_leaves_the_table_as_it_was(spark, folder, bad, said, prune_by):
    audit = Audit(rules={"place": F.col("p") >= 0})
    load_new(items(spark, (1, "a", 0)), folder, ITEMS, audit=audit)
    before = listing(folder)
    with pytest.raises(QualityError, match=said):
        load_new(items(spark, (1, "a", 0), *bad), folder, ITEMS, prune_by=prune_by, audit=audit)
    assert listing(folder) == before and not [d for d in os.listdir(folder) if d.startswith("_load")]
    assert load_new(items(spark, (2, "x", 1)), folder, ITEMS, prune_by=prune_by, audit=audit).inserted == 1
    assert rows(read_target(spark, folder, ITEMS)) == [(1, "a", 0), (2, "x", 1)]


def test_only_new_rows_are_audited(spark, folder):
    """A known key may come twice: it is not loaded."""
    load_new(items(spark, (1, "a", 0)), folder, ITEMS)
    batch = items(spark, (1, "b", 0), (1, None, 0), (2, "c", 0))
    assert load_new(batch, folder, ITEMS, audit=Audit()).inserted == 1


def test_min_rows_counts_the_table_with_the_batch(spark, folder):
    none = items(spark, (1, "a", 0)).limit(0)
    with pytest.raises(QualityError, match="fewer than 1 rows"):
        load_new(none, folder, ITEMS, audit=Audit(min_rows=1))
    load_new(items(spark, (1, "a", 0)), folder, ITEMS, audit=Audit(min_rows=1))
    assert load_new(none, folder, ITEMS, audit=Audit(min_rows=1)).inserted == 0
    with pytest.raises(QualityError, match="fewer than 4 rows"):
        load_new(items(spark, (2, "a", 0), (3, "a", 0)), folder, ITEMS, audit=Audit(min_rows=4))
    assert load_new(items(spark, (2, "a", 0), (3, "a", 0)), folder, ITEMS, audit=Audit(min_rows=3)).inserted == 2


def users(spark, *made):
    return spark.createDataFrame([(i, "f", "l", "g", level) for i, level in made], "id int, f string, l string, g string, level string").toDF(*DIM_USERS.columns)


def test_a_failing_dimension_is_not_switched_to(spark, folder, database):
    name = f"{database}.users"
    ensure_table(spark, DIM_USERS, folder, name)
    load_dimension(users(spark, (1, "free")), DIM_USERS, folder, name=name, audit=Audit(min_rows=1))
    at, files = table_location(spark, name), listing(folder)
    for batch in (users(spark, (2, "a"), (2, "b")), users(spark, (None, "a")), users(spark, (2, "a")).limit(0)):
        with pytest.raises(QualityError):
            load_dimension(batch, DIM_USERS, folder, name=name, audit=Audit(min_rows=1))
    with pytest.raises(QualityError):
        upsert_dimension(users(spark, (None, "a")), DIM_USERS, folder, name=name, audit=Audit())
    assert table_location(spark, name) == at and listing(folder) == files
    assert rows(spark.table(name).select("id")) == [(1,)]


def test_copies_get_ids_of_their_own_and_others_keep_theirs(spark, folder):
    spec = table("f", "id bigint, t int, v string", pk="id", not_null="t")
    made = spark.createDataFrame([(1, "a")] * 3 + [(2, None), (3, "b")], "t int, v string")
    load_fact(made, folder, spec, ["t"], audit=Audit())
    got = read_target(spark, folder, spec)
    assert got.count() == 5 and got.select("id").distinct().count() == 5
    alone = f"{folder}-once"
    load_fact(made.distinct(), alone, spec, ["t"], audit=Audit())
    assert set(rows(read_target(spark, alone, spec))) <= set(rows(got))


def test_the_audit_reads_no_old_rows(spark, folder, monkeypatch):
    """Checks see the new rows only, in the folder aside."""
    seen = []
    check = Audit.check
    monkeypatch.setattr(Audit, "check", lambda self, spec, new, observed, target: seen.append((new.inputFiles(), observed["n"])) or check(self, spec, new, observed, target))
    for n in range(2):
        load_new(items(spark, (n, "a", 0)), folder, ITEMS, audit=Audit())
    assert [n for _, n in seen] == [1, 1] and all("/_load-" in f for fs, _ in seen for f in fs)
