import json
from datetime import date, datetime

import pytest

from pyspark.sql import functions as F

from starmart.operators import QualityError, check_keys, check_unique
from starmart.plans import recipes
from starmart.plans.runs import run_lake, run_steps, run_warehouse
from starmart.schemas import LAKE_SONGS_BY_ARTIST, LAKE_SONGPLAYS, STAGING_EVENTS, STAGING_SONGS, table
from starmart.sinks import LoadResult
from conftest import rows

SONGS = [
    dict(num_songs=1, artist_id="a1", artist_name="A", artist_location="here", song_id="s1", title="x", duration=10.0, year=2000),
    dict(num_songs=1, artist_id="a1", artist_name="A", artist_location="there", song_id="s2", title="y", duration=20.5, year=0),
    dict(num_songs=1, artist_id="", artist_name="B", song_id="s3", title="z", duration=5.0, year=None),
]


def play(user, ms, song="x", level="free", page="NextSong", length=10.0):
    return dict(
        artist="A", song=song, length=length, userId=user, firstName="F" + user, lastName="L",
        gender="F", level=level, page=page, ts=ms, sessionId=1, location="here", userAgent="ua",
    )


MORNING = 1_541_293_200_000  # 2018-11-04 01:00:00
DAY_1 = [
    play("8", MORNING),
    play("8", MORNING + 400, song="y", length=20.5),
    play("8", MORNING + 12 * 3_600_000, level="paid"),
    play("", MORNING + 5_000),
    play("x", MORNING + 6_000),
    play("9", None),
    play("9", MORNING + 7_000, page="Home"),
]
DAY_2 = [play("9", MORNING + 86_400_000, song="unknown"), play("8", MORNING + 90_000_000, level="free")]


@pytest.fixture
def raw(tmp_path):
    def put(name, records):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(json.dumps(r) + "\n" for r in records))

    for i, song in enumerate(SONGS):
        put(f"song_data/A/B/C/{i}.json", [song])
    put("log-data/2018/11/a.json", DAY_1)
    put("log-data/2018/11/b.json", DAY_2)
    put("log_data/2018/11/04/a.json", DAY_1)
    put("log_data/2018/11/05/a.json", DAY_2)
    return str(tmp_path)


def test_warehouse_day_by_day(spark, raw, folder, database):
    def load(day):
        report = run_warehouse(
            spark, f"{raw}/log_data", f"{raw}/song_data", folder, day=day, schema=database
        )
        return {r.step: r.inserted for r in report.collect()}

    first = load(date(2018, 11, 4))
    assert first["staging_events"] == 7 and first["staging_songs"] == 3
    assert first["fact_songplays"] == 3
    assert first["dim_users"] == 1 and first["dim_songs"] == 2 and first["dim_artists"] == 1
    assert rows(spark.table(f"{database}.dim_users")) == [(8, "F8", "L", "F", "paid")]
    assert first["dim_time"] == 4  # any dated play, identified or not
    assert load(date(2018, 11, 4))["fact_songplays"] == 0
    second = load(date(2018, 11, 5))
    assert second["fact_songplays"] == 2 and second["dim_users"] == 1 and second["dim_time"] == 2
    named = {n: spark.table(f"{database}.{n}") for n in ("fact_songplays", "dim_users", "dim_time", "staging_events", "staging_songs")}
    assert rows(named["dim_users"].select("id", "level")) == [(8, "free"), (9, "free")]
    assert named["dim_time"].count() == 6 and named["staging_events"].count() == 2
    for key, dim in (("user_id", "dim_users"), ("start_time", "dim_time")):
        keys = named[dim].select(named[dim].columns[0]).toDF(key)
        assert named["fact_songplays"].join(keys, key, "left_anti").count() == 0
    fact = spark.read.parquet(f"{folder}/fact_songplays")
    assert fact.count() == 5 and check_unique(fact, "id").count() == 0
    assert rows(fact.select("start_time", "user_id", "song_id").filter("song_id is null")) == [
        (datetime(2018, 11, 5, 1), 9, None)
    ]


def test_warehouse_can_append_to_all_dimensions(spark, raw, folder, database):
    for _ in range(2):
        report = run_warehouse(
            spark, f"{raw}/log_data", f"{raw}/song_data", folder, schema=database, append=True
        )
    assert {r.step: r.inserted for r in report.collect() if r.step.startswith("dim")} == {
        "dim_artists": 0, "dim_songs": 0, "dim_time": 0, "dim_users": 0,
    }


def test_users_are_numbers_before_they_are_ranked(spark):
    log, _ = frames(spark)
    for i, text in enumerate(("8", "08", " 8")):
        extra = log.filter("userId = '8'").withColumn("userId", F.lit(text)).withColumn("ts", F.lit(MORNING + i))
        log = log.unionByName(extra.withColumn("level", F.lit(f"l{i}")))
    got = recipes.users(log)
    assert check_unique(got, "id").count() == 0
    assert rows(got.filter("id = 8").select("level")) == [("free",)]


def test_key_checks(spark):
    ok = spark.createDataFrame([("a", 1)], "id string, n int")
    spec = table("t", "id string, n int", pk="id", not_null="n")
    check_keys(ok, spec)
    with pytest.raises(QualityError, match="repeated"):
        check_keys(ok.unionByName(ok), spec)
    with pytest.raises(QualityError, match="nulls"):
        check_keys(spark.createDataFrame([("a", None)], "id string, n int"), spec)


def test_warehouse_fails_its_check_when_a_table_is_empty(spark, raw, folder, database, tmp_path):
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "a.json").write_text("")
    with pytest.raises(QualityError, match="dim_songs"):
        run_warehouse(spark, f"{raw}/log_data", str(empty), folder, schema=database)


def test_lake_loads_only_what_is_new(spark, raw, folder):
    for spec in (None, LAKE_SONGS_BY_ARTIST):
        base = f"{folder}/{'by-artist' if spec else 'plain'}"
        options = {"song_spec": spec} if spec else {}
        first = {r.step: r.inserted for r in run_lake(spark, raw, base, **options).collect()}
        assert first == {
            "staging songs": 3, "staging log": 9, "songs": 2, "artists": 1, "time": 6, "users": 4, "songplays": 6,
        }
        again = run_lake(spark, raw, base, **options).filter("step not like 'staging%'")
        assert [r.inserted for r in again.collect()] == [0] * 5
        plays = spark.read.schema(LAKE_SONGPLAYS.schema).parquet(f"{base}/transformed/songplays")
        assert rows(plays.select("userId", "year", "month").distinct()) == [
            ("8", 2018, 11), ("9", 2018, 11), ("x", 2018, 11),
        ]


def test_songs_are_looked_up_for_plays_that_are_not_loaded(spark, raw, folder, monkeypatch):
    looked_up, plain = [], recipes.enrich
    monkeypatch.setattr(recipes, "enrich", lambda log, *a, **b: looked_up.append(log.count()) or plain(log, *a, **b))
    for _ in range(2):
        run_lake(spark, raw, folder)
    with open(f"{raw}/log-data/2018/11/c.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in [play("7", MORNING + 8_000)] * 2)
    report = {r.step: r.inserted for r in run_lake(spark, raw, folder).collect()}
    assert looked_up == [6, 0, 2] and report["songplays"] == 2
    plays = spark.read.schema(LAKE_SONGPLAYS.schema).parquet(f"{folder}/transformed/songplays")
    assert plays.count() == plays.select("id").distinct().count() == 8


def frames(spark):
    log = spark.createDataFrame([(*[r.get(c) for c in STAGING_EVENTS.columns],) for r in DAY_1 + DAY_2], STAGING_EVENTS.schema)
    songs = spark.createDataFrame([(*[r.get(c) for c in STAGING_SONGS.columns],) for r in SONGS], STAGING_SONGS.schema)
    return log, songs


def test_recipes_differ_where_they_should(spark):
    log, songs = frames(spark)
    assert rows(recipes.lake_users(log, latest=False).filter("userId = '8'").select("level")) == [("free",), ("paid",)]
    assert rows(recipes.lake_users(log).filter("userId = '8'").select("level")) == [("free",)]
    assert recipes.lake_songplays(log, songs, keep_undated=True).count() == recipes.lake_songplays(log, songs).count() + 1
    assert rows(recipes.artists_all(songs).select("id", "location")) == [("", None), ("a1", "here"), ("a1", "there")]
    assert rows(recipes.artists(songs).select("id", "location")) == [("a1", "here")]
    assert rows(recipes.lake_songs(songs).select("song_id", "year")) == [("s1", "2000"), ("s2", "0")]
    assert rows(recipes.times(log).filter("hour = 13").select("weekday", "week")) == [(0, 44)]
    assert rows(recipes.lake_times(log).filter("hour = 13").select("weekday", "week")) == [("7", 44)]
    assert recipes.users_by_time(log).filter("id = '8'").count() == 1


def test_steps_run_in_order_and_stop_at_a_failure(spark):
    done = []

    def fail():
        raise RuntimeError("no")

    steps = [("a", lambda: done.append("a") or 3), ("b", lambda: done.append("b") or LoadResult(1, 2))]
    assert rows(run_steps(spark, steps)) == [("a", 3, None), ("b", 1, 2)]
    with pytest.raises(RuntimeError):
        run_steps(spark, [("f", fail), *steps])
    assert done == ["a", "b"]
