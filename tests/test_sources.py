from datetime import date
from pathlib import Path

import pytest

from starmart.schemas import STAGING_EVENTS, table
from starmart.sources import CORRUPT_COLUMN, date_prefix, read_json, stage_json
from starmart.sources.json_files import good_rows
from conftest import rows

SPEC = table("t", "userId string, firstName string, length double, status int")


@pytest.fixture
def raw(tmp_path):
    def put(name: str, *lines: str) -> str:
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return str(tmp_path / "raw")

    return put


@pytest.fixture
def json_bad(raw):
    return raw(
        "a.json",
        '{"userId": "8", "firstName": "Ann", "length": 1.5, "status": 200, "extra": true}',
        '{"userId": "", "firstname": "other case", "status": 404}',
        '{"userId": "9", "length": "", "status": 200}',
        '{"userId": "10", "firstName"',
    )


def test_bad_lines_are_kept_beside_the_good(spark, json_bad):
    df = read_json(spark, json_bad, SPEC)
    assert df.columns == [*SPEC.columns, CORRUPT_COLUMN]
    df = df.cache()
    assert rows(good_rows(df)) == [("", None, None, 404), ("8", "Ann", 1.5, 200)]
    bad = [r[CORRUPT_COLUMN] for r in df.filter(df[CORRUPT_COLUMN].isNotNull()).collect()]
    assert len(bad) == 2 and any(line.startswith('{"userId": "10"') for line in bad)


def test_bad_lines_can_be_dropped_or_fail(spark, json_bad):
    dropped = read_json(spark, json_bad, SPEC, "drop")
    assert rows(dropped) == [("", None, None, 404), ("8", "Ann", 1.5, 200)]
    # Spark parses only what is asked for, so here the bad length is not noticed.
    assert rows(dropped.select("userId")) == [("",), ("8",), ("9",)]
    with pytest.raises(Exception, match="MALFORMED"):
        read_json(spark, json_bad, SPEC, "fail").collect()
    with pytest.raises(ValueError):
        read_json(spark, json_bad, SPEC, "ignore")


def test_folders_are_read_as_prefixes_and_globs_by_depth(spark, raw):
    raw("2018/11/a.json", '{"userId": "1"}')
    base = raw("2018/11/02/b.json", '{"userId": "2"}')
    assert rows(read_json(spark, base, SPEC, "drop").select("userId")) == [("1",), ("2",)]
    assert rows(read_json(spark, f"{base}/*/*/*.json", SPEC, "drop").select("userId")) == [("1",)]


def test_staging_replaces_appends_and_backfills_a_day(spark, raw, folder):
    raw("2018/11/01/a.json", '{"userId": "1"}', '{"userId": "2"}')
    base = raw("2018/11/02/a.json", '{"userId": "3"}', "broken")

    def users():
        return [r.userId for r in spark.read.parquet(folder).orderBy("userId").collect()]

    assert stage_json(spark, base, folder, SPEC, corrupt="drop") == 3
    assert users() == ["1", "2", "3"]
    assert stage_json(spark, base, folder, SPEC, day=date(2018, 11, 1)) == 2
    assert users() == ["1", "2"]
    assert stage_json(spark, base, folder, SPEC, mode="append", day=date(2018, 11, 2)) == 2
    staged = spark.read.parquet(folder)
    assert staged.count() == 4 and good_rows(staged).count() == 3


def test_date_prefix():
    assert date_prefix("s3a://b/log_data/", date(2018, 11, 2)) == "s3a://b/log_data/2018/11/02/"
    assert date_prefix("x", date(2018, 1, 2), "hive") == "x/year=2018/month=1/day=2/"
    assert date_prefix("x", None) == "x"
    with pytest.raises(ValueError):
        date_prefix("x", date(2018, 1, 2), "flat")


def test_reading_runs_no_inference_job(spark, json_bad):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("inference", "reading")
    read_json(spark, json_bad, STAGING_EVENTS)
    assert list(tracker.getJobIdsForGroup("inference")) == []
    spark.sparkContext.setJobGroup("rest", "rest")
    assert Path(json_bad).exists()
