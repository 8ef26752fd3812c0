import json
import os
from datetime import datetime, timezone

import pytest

from starmart.plans import recipes
from starmart.schemas import STAGING_EVENTS, table
from starmart.session import work_dir
from starmart.sinks import ensure_table, read_target
from starmart.sources import stage_json
from starmart.sources.json_files import good_rows
from starmart.streaming import (
    read_json_stream,
    read_stream_fact,
    remembered,
    stream_dedup,
    stream_dedup_keyed,
    stream_dedup_within,
    stream_fact,
    stream_stage,
    stream_upsert_latest,
)
from conftest import rows
from test_runs import DAY_1, DAY_2, frames

DATED = table("users", "userId string, level string, ts bigint", pk="userId")


@pytest.fixture
def arrive(tmp_path):
    base = tmp_path / "incoming"
    base.mkdir()

    def put(name, records):
        (base / name).write_text("".join(json.dumps(r) + "\n" for r in records))
        return str(base)

    return put


def test_staging_takes_each_file_once(spark, arrive, folder):
    state = work_dir(spark, "state")
    src = arrive("a.json", DAY_1)
    for _ in range(2):
        stream_stage(spark, src, folder, STAGING_EVENTS, state).awaitTermination()
    assert spark.read.parquet(folder).count() == len(DAY_1)
    arrive("b.json", DAY_2)
    stream_stage(spark, src, folder, STAGING_EVENTS, state).awaitTermination()
    assert spark.read.parquet(folder).count() == len(DAY_1) + len(DAY_2)


def test_fact_in_two_waves_equals_batch(spark, arrive, folder):
    log, songs = frames(spark)
    state = work_dir(spark, "state")

    def run(checkpoint):
        stream = read_json_stream(spark, src, STAGING_EVENTS, files_per_trigger=1)
        stream_fact(stream, songs, folder, checkpoint).awaitTermination()

    src = arrive("a.json", DAY_1)
    run(state)
    arrive("b.json", DAY_2)
    run(state)
    batch = recipes.songplays(log, songs)
    fact = read_stream_fact(spark, folder)
    assert rows(fact.select(*batch.columns)) == rows(batch)
    # A lost checkpoint repeats every file; the fact does not grow.
    run(work_dir(spark, "state"))
    assert read_stream_fact(spark, folder).count() == batch.count()


@pytest.mark.parametrize("n_files", [1, 2, 4])
def test_equal_plays_are_loaded_however_the_files_part_them(spark, arrive, folder, n_files):
    _, songs = frames(spark)
    for n in range(n_files):
        src = arrive(f"{n}.json", [r for k, r in enumerate(DAY_1[:4] * 4) if k % n_files == n])
    stream = read_json_stream(spark, src, STAGING_EVENTS, files_per_trigger=1)
    stream_fact(stream, songs, folder, work_dir(spark, "state")).awaitTermination()
    fact = read_stream_fact(spark, folder)
    assert fact.count() == 12 and fact.select("id").distinct().count() == 12


def test_a_repeated_batch_replaces_its_folder(spark, arrive, folder):
    log, songs = frames(spark)
    state = f"{folder}-state"
    for n, day in enumerate((DAY_1, DAY_2)):
        src = arrive(f"{n}.json", day)

    def run():
        stream = read_json_stream(spark, src, STAGING_EVENTS, files_per_trigger=1)
        stream_fact(stream, songs, folder, state).awaitTermination()
        return rows(read_stream_fact(spark, folder).drop("id"))

    first = run()
    for name in os.listdir(f"{state}/commits"):
        if name.strip(".").startswith("1"):
            os.remove(f"{state}/commits/{name}")
    assert run() == first and len(first) == recipes.songplays(log, songs).count()


def test_dedup_within_the_watermark(spark, arrive, folder):
    spec = table("t", "user string, at timestamp")
    src = arrive("a.json", [dict(user=u, at="2024-01-01T00:00:00") for u in "aab"])
    arrive("b.json", [dict(user="a", at="2024-01-01T00:00:00"), dict(user="c", at="2024-01-01T00:00:01")])
    raw = read_json_stream(spark, src, spec, corrupt="drop")
    stream = stream_dedup_within(raw, ["user", "at"], "at", "1 hour")
    query = (
        stream.writeStream.format("parquet").option("path", folder)
        .option("checkpointLocation", work_dir(spark, "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1)
    assert rows(spark.read.parquet(folder)) == [("a", first), ("b", first), ("c", second)]


def test_keyed_state_forgets_on_time(spark, arrive, folder):
    """Late, repeated and expired keys over several runs, against the rule in plain Python."""
    spec, state = table("t", "user string, n int, at timestamp"), work_dir(spark, "state")
    waves = [
        [("a", 1, 10), ("a", 2, 9), ("b", 3, 10), (None, 4, 11), (None, 5, 12), ("x", 6, None)],
        [("a", 7, 12), ("c", 8, 20), ("late", 9, 15)],
        [("a", 10, 19), ("late", 11, 3), ("b", 12, 40)],
        [("a", 13, 39), ("b", 14, 41), ("c", 15, 70)],
        [("b", 16, 69), ("a", 17, 68), ("c", 18, 71)],
    ]
    keep, delay, latest, watermark = 12, 5, -1, -1
    seen: dict = {}
    want = []
    for k, wave in enumerate(waves):
        src = arrive(f"{k}.json", [dict(user=u, n=n, at=None if h is None else f"2024-01-{1 + h // 24:02}T{h % 24:02}:00:00") for u, n, h in wave])
        stream = read_json_stream(spark, src, spec, corrupt="drop")
        stream_dedup_keyed(stream, ["user"], "at", keep * 3600, f"{delay} hours", folder, state).awaitTermination()
        # A run is one batch, and then one without rows if the watermark has moved.
        rows_ = [(h, u, n) for u, n, h in wave if h is not None and h >= watermark]
        for h, u, n in sorted(rows_, key=lambda r: (r[0], r[2])):
            if u not in seen:
                seen[u] = h + keep
                want.append((u, n))
        latest = max([latest, *[h for _, _, h in wave if h is not None]])
        watermark = latest - delay
        seen = {u: until for u, until in seen.items() if until > watermark}
    assert rows(spark.read.parquet(folder).select("user", "n")) == sorted(want, key=repr)
    held = {r["user"]: r["until"] for r in remembered(spark, state).collect()}
    hour = lambda h: int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp() + h * 3600) * 1000
    assert held == {u: hour(until) for u, until in seen.items()}


def test_late_rows_are_neither_lost_nor_doubled(spark, arrive, folder):
    spec = table("t", "user string, at timestamp", pk="user at", sort_by="at")
    hours = [("a", 12), ("b", 13)], [("new", 2), ("a", 12)], [("new", 2), ("b", 13)], [(None, 1), (None, 1)]
    for i, rows_ in enumerate(hours):
        src = arrive(f"{i}.json", [dict(user=u, at=f"2024-01-01T{h:02}:00:00") for u, h in rows_])
    stream = read_json_stream(spark, src, spec, files_per_trigger=1)
    for _ in range(2):
        stream_dedup(stream, folder, spec, work_dir(spark, "state")).awaitTermination()
    got = [(r["user"], r["at"].hour) for r in read_target(spark, folder, spec).collect()]
    assert sorted(got, key=str) == sorted([("a", 12), ("b", 13), ("new", 2), (None, 1)], key=str)


def test_unmatched_plays_survive_several_batches(spark, arrive, folder):
    log, songs = frames(spark)
    for i, day in enumerate((DAY_1, DAY_2)):
        src = arrive(f"{i}.json", day)
    key = ("start_time", "user_id", "session_id", "song_id")
    stream = read_json_stream(spark, src, STAGING_EVENTS, files_per_trigger=1)
    with pytest.raises(Exception, match="may be null"):
        stream_fact(stream, songs, folder, work_dir(spark, "state"), key).awaitTermination()
    for _ in range(2):
        state = work_dir(spark, "state")
        stream_fact(stream, songs, folder, state, key, nulls="equal").awaitTermination()
    batch = recipes.songplays(log, songs)
    assert batch.filter("song_id IS NULL").count() > 0
    assert rows(read_stream_fact(spark, folder).select(*batch.columns)) == rows(batch)


def test_bad_lines_are_kept_as_the_batch_reader_keeps_them(spark, tmp_path, folder):
    base = tmp_path / "bad"
    base.mkdir()
    good = json.dumps(DAY_1[0])
    (base / "a.json").write_text(good + '\nnot json\n{"ts": "text", "page": "NextSong"}\n')
    stream_stage(spark, str(base), folder, STAGING_EVENTS, work_dir(spark, "state")).awaitTermination()
    batch = work_dir(spark, "batch")
    stage_json(spark, str(base), batch, STAGING_EVENTS)
    streamed = spark.read.parquet(folder)
    assert rows(streamed) == rows(spark.read.parquet(batch))
    assert good_rows(streamed).count() == 1


def test_upserts_keep_the_newest_level_in_any_order(spark, arrive, folder, database):
    name = f"{database}.users"
    ensure_table(spark, DATED, folder, name)
    state = work_dir(spark, "state")
    src = arrive("a.json", [dict(userId="1", level="paid", ts=30), dict(userId="1", level="free", ts=10)])

    def run():
        stream = read_json_stream(spark, src, DATED)
        stream_upsert_latest(stream, DATED, folder, state, "ts", name).awaitTermination()

    run()
    arrive("b.json", [dict(userId="1", level="free", ts=20), dict(userId="2", level="free", ts=5)])
    run()
    assert rows(spark.table(name)) == [("1", "paid", 30), ("2", "free", 5)]
