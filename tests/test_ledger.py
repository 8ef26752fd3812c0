import json
import os

import pytest
from conftest import rows

from starmart import files
from starmart.schemas import table
from starmart.sources import ledger, read_ledger, read_staged, stage_new_files

SPEC = table("t", "a int, b string")


@pytest.fixture
def put(folder):
    def write(name, *lines, at=None):
        path = f"{folder}/raw/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
        if at:
            os.utime(path, (at, at))

    return write


@pytest.fixture
def stage(spark, folder):
    return lambda **k: stage_new_files(spark, f"{folder}/raw", f"{folder}/staged", f"{folder}/ledger", SPEC, **k)


@pytest.fixture
def read(spark, folder):
    return lambda **k: rows(read_staged(spark, f"{folder}/staged", f"{folder}/ledger", SPEC, **k))


def test_each_file_once(stage, put, read):
    put("x/one.json", {"a": 1, "b": "x"}, {"a": 2})
    put("two.json", {"a": 3})
    put("two.csv", "no json")
    assert stage() == (1, 2, 3) and stage() == (0, 0, 0)
    put("three and more.json", {"a": 4})
    assert stage() == (1, 1, 1)
    assert [r[0] for r in read()] == [1, 2, 3, 4]
    assert [r[0] for r in read(after=1)] == [4] and read(after=2) == []


def test_replaced_files(stage, put, read):
    put("one.json", {"a": 1}, at=1_000_000)
    put("two.json", {"a": 2}, at=1_000_000)
    stage()
    put("one.json", {"a": 7}, at=2_000_000)  # the same length, another time
    assert stage() == (1, 1, 1) and [r[0] for r in read()] == [2, 7]
    put("one.json", {"a": 1}, at=1_000_000)  # and back: the ledger's latest entry is another
    assert stage() == (1, 1, 1) and [r[0] for r in read()] == [1, 2]


def test_batches_of_bounded_size(stage, put, read):
    for n in range(5):
        put(f"{n}.json", {"a": n}, at=1_000_000 + n)
    assert stage(max_files=2) == (3, 5, 5) and len(read()) == 5


def test_a_batch_counts_when_its_ledger_is_complete(spark, folder, stage, put, read):
    put("one.json", {"a": 1})
    stage()
    put("two.json", {"a": 2})
    stage()
    os.remove(f"{folder}/ledger/{ledger.BATCH_COLUMN}=2/_SUCCESS")  # as if the run had died before
    assert read_ledger(spark, f"{folder}/ledger").count() == 1 and [r[0] for r in read()] == [1]
    put("three.json", {"a": 3})
    assert stage() == (1, 2, 2) and [r[0] for r in read()] == [1, 2, 3]


def test_lines_that_do_not_parse(stage, put, read):
    put("one.json", {"a": 1}, "not json")
    assert stage() == (1, 1, 2) and [r[0] for r in read()] == [1]


def test_one_day(stage, put, read):
    from datetime import date

    put("2018/11/01/x.json", {"a": 1})
    put("2018/11/02/x.json", {"a": 2})
    assert stage(day=date(2018, 11, 2)) == (1, 1, 1) and stage().files == 1
    assert [r[0] for r in read()] == [1, 2]


def test_only_one_creates(spark, folder):
    assert files.create_new(spark, f"{folder}/a/b") and not files.create_new(spark, f"{folder}/a/b")
    assert list(files.files_below(spark, folder)) == ["a/b"] and files.names(spark, f"{folder}/none") == []
    with pytest.raises(OSError):
        files.create_new(spark, f"{folder}/c")
        files.move(spark, f"{folder}/c", f"{folder}/a/b")
