"""Registered queries: every operator over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Queries whose subject is a sink, a load or a
stream write below the session's shared checkpoint folder first and return what was written.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import (
    compose_key,
    epoch_ms_to_ts,
    hash_key,
    time_key,
    ts_to_epoch_ms,
    ts_to_epoch_seconds,
)
from starmart.functions.textkeys import TIME_KEY_12H, TIME_KEY_24H
from starmart.operators import (
    add_id,
    anti_new,
    as_of,
    check_min_rows,
    check_not_null,
    check_unique,
    conform,
    distinct_rows,
    enrich,
    enrich_near,
    impute_missing,
    latest_per_key,
    merge_latest,
    preview,
    row_counts,
)
from starmart.operators.id_ranges import taken_blocks
from starmart.operators.quality import QualityError
from starmart.plans import recipes
from starmart.plans.bindings import TABLES, log, song_feed, songs, table, visits
from starmart.plans.recipes import SONG_IDS, SONG_MATCH, USER_FIELDS, USER_NAMES
from starmart.plans.runs import run_lake, run_warehouse
from starmart.schemas import (
    DIM_ARTISTS_WHOLE,
    DIM_SONGS_WHOLE,
    DIM_TIME,
    DIM_TIME_TEXT,
    DIM_USERS,
    FACT_SONGPLAYS,
    LAKE,
    MISSING_TEXT,
    PLAY_PAGE,
    STAGING,
    STAGING_EVENTS,
    STAGING_EVENTS_WHOLE,
    STAGING_SONGS,
    STAGING_SONGS_WHOLE,
    WAREHOUSE,
)
from starmart.schemas import table as table_spec
from starmart.session import dropping_shuffles, work_dir
from starmart.sinks import (
    Audit,
    add_keys,
    append,
    append_bucketed,
    drop_table,
    ensure_parted,
    ensure_table,
    filtered_anti_new,
    load_dimension,
    load_fact,
    load_new,
    new_for_bucketed,
    read_history,
    read_parted,
    read_target,
    replay_days,
    table_location,
    update_history,
    upsert_dimension,
    upsert_parts,
    write_parquet,
)
from starmart import files
from starmart.sources import date_prefix, read_json, read_staged, stage_json, stage_new_files
from starmart.sources.json_files import good_rows
from starmart.streaming import (
    read_json_stream,
    read_stream_fact,
    stream_dedup,
    stream_dedup_keyed,
    stream_dedup_within,
    stream_fact,
    stream_stage,
    stream_upsert_latest,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The events of the given tables lie in January 2024: loads are split in the middle of the month.
SPLIT = "ts < timestamp_ntz'2024-01-15 00:00:00'"
SPLIT_NOON = "ts < timestamp_ntz'2024-01-15 12:00:00'"
SPLIT_MS = 1_705_276_800_000
ONE_DAY = date(2024, 1, 3)
# Files of daily visits are cut for several tasks to write and read them.
DAILY_FILE_ROWS = 250_000
# Packed files of the log are read by one task each.
LOG_FILE_ROWS = 1_000_000

VISIT_SPEC = table_spec(
    "visits",
    "event_id bigint, userId string, firstName string, lastName string, gender string, level string, "
    "page string, ts bigint, sessionId int, location string, userAgent string",
    pk="event_id",
)
USERS_DATED = table_spec(
    "users_dated",
    "userId int, firstName string, lastName string, gender string, level string, ts bigint",
    pk="userId",
)
SECONDS = table_spec("seconds", "start_time timestamp, userId string", pk="start_time userId", sort_by="start_time")
KNOWN_EVENTS = table_spec("known_events", "event_id bigint, ts timestamp", pk="event_id")
EVENTS_BY_DAY = table_spec(
    "events_by_day",
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string, "
    "year int, month int, day int",
    pk="event_id",
    partition_by="year month day",
)
# In the bound log one user plays several songs of a session within a second. The song is null where
# none matched.
STREAM_KEY = ("start_time", "user_id", "session_id", "song_id")


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore avoids an operator's name."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# --- Fact ---


@query
def songplays_fact(spark, sf_dir):
    return recipes.songplays(log(spark, sf_dir), songs(spark, sf_dir))


@query
def songplays_unmatched(spark, sf_dir):
    return songplays_fact(spark, sf_dir).filter(F.col("song_id").isNull())


@query
def songplays_keep_null_ts(spark, sf_dir):
    return recipes.lake_songplays(log(spark, sf_dir), songs(spark, sf_dir), keep_undated=True)


@query
def songplays_lake(spark, sf_dir):
    return recipes.lake_songplays(log(spark, sf_dir), songs(spark, sf_dir))


@query
def songplays_rounded(spark, sf_dir):
    return recipes.songplays(log(spark, sf_dir), songs(spark, sf_dir), round_to={"length": 0})


@query
def songplays_whole(spark, sf_dir):
    """Both staging tables in the whole-number layout: lengths meet as whole numbers."""
    events = conform(log(spark, sf_dir), STAGING_EVENTS_WHOLE)
    return recipes.songplays(events, conform(songs(spark, sf_dir), STAGING_SONGS_WHOLE))


@query
def songplays_first_match(spark, sf_dir):
    """Rounded lengths match several catalogue songs; each play keeps the first of them."""
    return recipes.songplays(
        log(spark, sf_dir), songs(spark, sf_dir), round_to={"length": 0}, fanout="first"
    )


def _listed_lines(spark, sf_dir):
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        F.col("p_brand").alias("artist"),
        F.col("p_name").alias("song"),
        (F.col("p_retailprice") + F.when(F.col("l_linenumber") == 7, 0.5).otherwise(0.0)).alias("length"),
    )


@query
def songplays_bulk(spark, sf_dir):
    return enrich(_listed_lines(spark, sf_dir), songs(spark, sf_dir), SONG_MATCH, SONG_IDS)


@query
def songplays_by_artist_salted(spark, sf_dir):
    """Few, hot join keys: every line against its artist's first song, hot artists salted."""
    first = recipes.artists(songs(spark, sf_dir)).withColumnRenamed("id", "artist_key")
    return enrich(
        _listed_lines(spark, sf_dir), first, {"artist": "artist_key"}, ["name", "location"], "error", salts=8
    )


@query
def songplays_tolerant(spark, sf_dir):
    """Lengths may be half a unit off, which is what parts every seventh line from its song."""
    return enrich_near(
        _listed_lines(spark, sf_dir), songs(spark, sf_dir), {"artist": "artist_name", "song": "title"},
        ("length", "duration"), 0.5, SONG_IDS,
    )


@query
def songplays_tolerant_salted(spark, sf_dir):
    """The nearest lengths of any song of the same artist: few, crowded keys, the hot bins salted."""
    return enrich_near(
        _listed_lines(spark, sf_dir), songs(spark, sf_dir), {"artist": "artist_name"}, ("length", "duration"), 0.05,
        SONG_IDS, salts=8, hot_share=0.0001,
    )


# --- Dimensions ---


@query
def songs_dim(spark, sf_dir):
    return recipes.songs(song_feed(spark, sf_dir))


@query
def songs_distinct(spark, sf_dir):
    return recipes.songs_all(song_feed(spark, sf_dir))


@query
def songs_lake(spark, sf_dir):
    return recipes.lake_songs(song_feed(spark, sf_dir))


@query
def songs_whole(spark, sf_dir):
    """Durations cast to whole numbers; shown as bigint."""
    whole = recipes.songs(songs(spark, sf_dir), DIM_SONGS_WHOLE)
    return whole.withColumn("duration", F.col("duration").cast("bigint"))


@query
def artists_dim(spark, sf_dir):
    return recipes.artists(song_feed(spark, sf_dir))


@query
def artists_lake(spark, sf_dir):
    return recipes.lake_artists(song_feed(spark, sf_dir))


@query
def artists_distinct(spark, sf_dir):
    return recipes.artists_all(song_feed(spark, sf_dir))


@query
def users_latest(spark, sf_dir):
    return recipes.users(visits(spark, sf_dir))


@query
def users_lake(spark, sf_dir):
    return recipes.lake_users(visits(spark, sf_dir))


@query
def users_distinct(spark, sf_dir):
    return recipes.lake_users(visits(spark, sf_dir), latest=False)


@query
def users_by_time_join(spark, sf_dir):
    return recipes.users_by_time(visits(spark, sf_dir))


@query
def latest_order_tiebreak(spark, sf_dir):
    return latest_per_key(
        table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", tie_breakers=["o_orderkey"]
    )


@query
def user_max_ts(spark, sf_dir):
    return recipes.plays(visits(spark, sf_dir)).groupBy("userId").agg(F.max("ts").alias("max_ts"))


@query
def time_dim_iso(spark, sf_dir):
    return recipes.times(visits(spark, sf_dir), weekday="iso")


@query
def time_dim_sun0(spark, sf_dir):
    return recipes.times(visits(spark, sf_dir))


@query
def time_dim_text(spark, sf_dir):
    return recipes.times(visits(spark, sf_dir), DIM_TIME_TEXT)


@query
def time_lake(spark, sf_dir):
    return recipes.lake_times(visits(spark, sf_dir))


@query
def time_dim_log(spark, sf_dir):
    return recipes.times(log(spark, sf_dir))


@query
def time_dim_seconds(spark, sf_dir):
    """Distinct milliseconds against distinct seconds: why seconds are cut before deduplication."""
    moments = distinct_rows(recipes.plays(log(spark, sf_dir)).filter(F.col("ts").isNotNull()), ["ts"])
    return moments.agg(
        F.count(F.lit(1)).alias("n_ms"), F.count_distinct(epoch_ms_to_ts("ts")).alias("n_seconds")
    )


# --- New rows only ---


@query
def new_by_key(spark, sf_dir):
    e = events(spark, sf_dir)
    return anti_new(e, e.filter(SPLIT), "event_id", unique_target=True)


@query
def new_by_key_nulls(spark, sf_dir):
    batch = events(spark, sf_dir).withColumn("kind", F.nullif("event_type", F.lit("error")))
    target = events(spark, sf_dir).filter(F.col("event_type") == "click")
    return anti_new(batch, target.select(F.col("event_type").alias("kind")), "kind")


@query
def new_by_empty_target(spark, sf_dir):
    batch = events(spark, sf_dir).withColumn("kind", F.nullif("event_type", F.lit("error")))
    return anti_new(batch, batch.filter(F.col("ts").isNull()), "kind")


def _hourly(spark, sf_dir):
    return events(spark, sf_dir).withColumn("hour_start", F.date_trunc("hour", "ts").cast("timestamp_ntz"))


def _new_by_text(spark, sf_dir, fmt):
    batch = _hourly(spark, sf_dir).withColumn(
        "text_key", compose_key([time_key("hour_start", fmt), "user_id"])
    )
    return anti_new(batch, batch.filter(SPLIT_NOON), "text_key")


@query
def new_by_composed_key_12h(spark, sf_dir):
    return _new_by_text(spark, sf_dir, TIME_KEY_12H)


@query
def new_by_composed_key_24h(spark, sf_dir):
    return _new_by_text(spark, sf_dir, TIME_KEY_24H)


@query
def new_by_typed_key(spark, sf_dir):
    batch = _hourly(spark, sf_dir)
    return anti_new(batch, batch.filter(SPLIT_NOON), ["hour_start", "user_id"])


@query
def new_by_filter(spark, sf_dir):
    """A batch against a target whose keys are in a sketch: only what may be known is compared."""
    sketch, e = work_dir(spark, "sketch"), events(spark, sf_dir)
    target = e.filter(SPLIT)
    for half in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        add_keys(target.filter(half), sketch, ["event_id"], expected_keys=100_000)
    return filtered_anti_new(e, target, ["event_id"], sketch)


@query
def new_by_bucketed_target(spark, sf_dir):
    """A batch against a table bucketed by the key, loaded in two parts."""
    base, e = work_dir(spark, "bucketed"), events(spark, sf_dir)
    name = f"known_{base[-8:]}"
    for part in (F.expr("ts < timestamp_ntz'2024-01-10'"), F.expr(f"ts >= timestamp_ntz'2024-01-10' AND {SPLIT}")):
        append_bucketed(e.filter(part), KNOWN_EVENTS, ["event_id"], 8, name, f"{base}/table")
    new = work_dir(spark, "new")
    new_for_bucketed(e, name, ["event_id"]).write.parquet(new)
    drop_table(spark, name)
    return spark.read.schema(e.schema).parquet(new)


@query
def merged_latest(spark, sf_dir):
    """The latest row per user, from one half of the month merged into the other."""
    dated = visits(spark, sf_dir).filter((F.col("userId") != "") & F.col("ts").isNotNull())
    rows = dated.select(*USERS_DATED.columns)
    older, newer = rows.filter(F.col("ts") < SPLIT_MS), rows.filter(F.col("ts") >= SPLIT_MS)
    target = latest_per_key(older, ["userId"], "ts", combine=True)
    return merge_latest(target, latest_per_key(newer, ["userId"], "ts", combine=True), ["userId"], "ts")


# --- Functions, cleaning, keys ---


@query
def epoch_seconds(spark, sf_dir):
    ms = events(spark, sf_dir).select(
        "event_id", ts_to_epoch_ms("ts").alias("epoch_ms"), ts_to_epoch_seconds("ts").alias("epoch_s")
    )
    return ms.withColumns(
        {"start_time": epoch_ms_to_ts("epoch_ms"), "start_time_ms": epoch_ms_to_ts("epoch_ms", "ms")}
    )


@query
def impute_partition_cols(spark, sf_dir):
    return impute_missing(
        visits(spark, sf_dir).select("event_id", "userId", "ts"), ["userId", "ts"], MISSING_TEXT
    )


@query
def conform_users(spark, sf_dir):
    people = distinct_rows(visits(spark, sf_dir), ["userId", *USER_FIELDS])
    return conform(people, DIM_USERS, USER_NAMES)


@query
def hash_ids(spark, sf_dir):
    """As many distinct hashes as distinct keys; the hash itself is engine-specific."""
    keys = distinct_rows(visits(spark, sf_dir), ["userId", "ts", "sessionId"])
    hashed = add_id(keys, "hash", cols=keys.columns)
    return hashed.agg(F.count(F.lit(1)).alias("n_keys"), F.count_distinct("id").alias("n_ids"))


@query
def hash_key_repeats(spark, sf_dir):
    """Rows of equal value have equal hashes: nothing is left after grouping by both."""
    kinds = events(spark, sf_dir).select("event_type", hash_key(["event_type"]).alias("id"))
    return kinds.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), (F.min("id") == F.max("id")).alias("same")
    )


def _id_summary(numbered):
    return numbered.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.min("id").alias("lowest"),
        F.max("id").alias("highest"),
    )


@query
def sequence_ids(spark, sf_dir):
    return _id_summary(add_id(songplays_fact(spark, sf_dir), "sequence", start=1))


@query
def sequence_ids_ordered(spark, sf_dir):
    """Numbers that follow (o_orderdate, o_orderkey)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return add_id(orders, "sequence", start=1, order_by=["o_orderdate", "o_orderkey"])


@query
def monotonic_ids(spark, sf_dir):
    numbered = add_id(songplays_fact(spark, sf_dir), "monotonic", start=1)
    return _id_summary(numbered).select("n_rows", "n_ids")


# --- Quality ---


def _all_tables(spark, sf_dir):
    return {name: table(spark, sf_dir, name) for name in TABLES}


@query
def row_counts_(spark, sf_dir):
    return row_counts(_all_tables(spark, sf_dir))


@query
def min_rows_check(spark, sf_dir):
    return check_min_rows(_all_tables(spark, sf_dir), 100).frame


@query
def pk_violations(spark, sf_dir):
    return check_unique(artists_distinct(spark, sf_dir), "id")


@query
def null_counts(spark, sf_dir):
    return check_not_null(log(spark, sf_dir), ["ts", "userId", "song"], blank=True)


@query
def preview_(spark, sf_dir):
    return preview(visits(spark, sf_dir).select(*VISIT_SPEC.columns), 10, ["event_id"])


# --- Sinks, loads, sources ---


@query
def load_twice_counts(spark, sf_dir):
    """Half the events, then all of them, then all again: rows inserted and skipped."""
    path = work_dir(spark, "load")
    e = events(spark, sf_dir)
    full = e.select("*", F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"))
    runs = [full.filter(SPLIT), full, full]
    report = [load_new(batch, path, EVENTS_BY_DAY, count_skipped=True) for batch in runs]
    return spark.createDataFrame(
        [(i + 1, r.inserted, r.skipped) for i, r in enumerate(report)],
        "load int, inserted bigint, skipped bigint",
    )


@query
def load_fact_twice(spark, sf_dir):
    """The fact after loading all plays, then all again; without the id."""
    path = work_dir(spark, "fact")
    batch = songplays_fact(spark, sf_dir)
    for _ in range(2):
        load_fact(batch, path, FACT_SONGPLAYS, ("start_time", "user_id"), prune_by=("start_time",))
    return read_target(spark, path, FACT_SONGPLAYS).drop("id")


@query
def load_fact_pruned(spark, sf_dir):
    """The lake fact in two loads, the second of one year and the quarter before it: of the target it
    reads the folders of those months only."""
    path = work_dir(spark, "lake-fact")
    spec = next(s for s in LAKE if s.name == "songplays")
    plays = songplays_lake(spark, sf_dir)
    late = (F.col("year") == 1998) | ((F.col("year") == 1997) & (F.col("month") >= 10))
    for batch in (plays.filter(F.col("year") != 1998), plays.filter(late)):
        prune_by = (*spec.partition_by, *spec.sort_by)
        load_fact(batch, path, spec, ("start_time", "userId"), prune_by=prune_by)
    return read_target(spark, path, spec).drop("id")


@query
def audited_load(spark, sf_dir):
    """Three loads of events by day; the second repeats a key and has a negative value, and is refused as a
    whole: the table holds the other two."""
    path = work_dir(spark, "audited")
    e = events(spark, sf_dir)
    days = e.select("*", F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"))
    audit = Audit(min_rows=1, rules={"no negative value": F.col("value") >= 0})
    early, late = days.filter(SPLIT), days.filter(~F.expr(SPLIT))
    bad = late.withColumn("value", F.when(F.col("day") == 20, -F.col("value")).otherwise(F.col("value")))
    refused = 0
    for batch in (early, bad, early.unionByName(late.unionByName(late.filter("day = 21"))), late):
        try:
            load_new(batch, path, EVENTS_BY_DAY, audit=audit)
        except QualityError:
            refused += 1
    return read_target(spark, path, EVENTS_BY_DAY).withColumn("refused", F.lit(refused))


@query
def fact_ids_over_loads(spark, sf_dir):
    """Dense ids of the fact after two loads: they go on where the first load ended."""
    path = work_dir(spark, "fact")
    plays = songplays_fact(spark, sf_dir)
    for batch in (plays.filter(F.year("start_time") < 1996), plays):
        load_fact(batch, path, FACT_SONGPLAYS, ("start_time", "user_id"), "sequence")
    ids = read_target(spark, path, FACT_SONGPLAYS)
    return ids.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


@query
def fact_ids_reserved(spark, sf_dir):
    """Two loads that number their plays at the same time, from blocks of one ledger."""
    path, ledger = work_dir(spark, "fact"), work_dir(spark, "ids")
    plays, block = songplays_fact(spark, sf_dir), 1000
    read_target(spark, path, FACT_SONGPLAYS)

    def load(part):
        key = ("start_time", "user_id")
        return load_fact(plays.filter(part), path, FACT_SONGPLAYS, key, "reserved", id_ledger=ledger, id_block=block)

    early = F.year("start_time") < 1996
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(load, (early, ~early)))
    taken = [(k * block + 1, (k + 1) * block) for k in taken_blocks(spark, ledger)]
    blocks = spark.createDataFrame(taken, "low bigint, high bigint")
    ids = read_target(spark, path, FACT_SONGPLAYS).join(F.broadcast(blocks), F.ceil(F.col("id") / block) * block == F.col("high"), "left")
    return ids.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.count_if(F.col("high").isNull()).alias("n_outside"),
        (F.lit(len(taken) * block) - F.count(F.lit(1)) < 2 * block).alias("small_gaps"),
    )


@query
def fact_hash_ids(spark, sf_dir):
    """Ids of a fact that was given every play twice in one batch: none is repeated."""
    path = work_dir(spark, "fact")
    plays = songplays_fact(spark, sf_dir)
    load_fact(plays.unionByName(plays), path, FACT_SONGPLAYS, ("start_time", "user_id"))
    ids = read_target(spark, path, FACT_SONGPLAYS)
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))


@query
def append_insert(spark, sf_dir):
    """Artists of the feed appended in two parts, cast to the whole-number layout."""
    path = work_dir(spark, "appended")
    rows = recipes.artists(song_feed(spark, sf_dir), DIM_ARTISTS_WHOLE)
    for part in (F.col("id") < "Brand#3", F.col("id") >= "Brand#3"):
        append(rows.filter(part), path, DIM_ARTISTS_WHOLE)
    whole = {c: F.col(c).cast("bigint") for c in ("latitude", "longitude")}
    return read_target(spark, path, DIM_ARTISTS_WHOLE).withColumns(whole)


@query
def dimension_refresh(spark, sf_dir):
    """A dimension filled, then refreshed by appending: the second load adds only new keys."""
    base = work_dir(spark, "dimension")
    name = f"dim_users_{base[-8:]}"
    ensure_table(spark, DIM_USERS, base, name)
    v = visits(spark, sf_dir)
    load_dimension(recipes.users(v.filter(F.col("ts") < SPLIT_MS)), DIM_USERS, base, name=name)
    load_dimension(recipes.users(v), DIM_USERS, base, append=True, name=name)
    folder = table_location(spark, name)
    drop_table(spark, name)
    return read_target(spark, folder, DIM_USERS)


@query
def upsert_users(spark, sf_dir):
    """Users of the first half of the month, then the second half upserted."""
    base = work_dir(spark, "upsert")
    name = f"users_{base[-8:]}"
    ensure_table(spark, USERS_DATED, base, name)
    dated = recipes.plays(visits(spark, sf_dir)).filter(F.col("ts").isNotNull())
    rows = recipes.numbered_users(dated).select(*USERS_DATED.columns)
    for half in (rows.filter(F.col("ts") < SPLIT_MS), rows.filter(F.col("ts") >= SPLIT_MS)):
        latest = latest_per_key(half, USERS_DATED.pk, "ts", combine=True)
        upsert_dimension(latest, USERS_DATED, base, "ts", name)
    folder = table_location(spark, name)
    drop_table(spark, name)
    return conform(read_target(spark, folder, USERS_DATED), DIM_USERS, USER_NAMES)


@query
def upsert_users_parts(spark, sf_dir):
    """The same into a table in eight parts, of which an upsert rewrites the touched ones."""
    base = work_dir(spark, "parted")
    name = f"users_{base[-8:]}"
    ensure_parted(spark, USERS_DATED, base, name)
    dated = recipes.plays(visits(spark, sf_dir)).filter(F.col("ts").isNotNull())
    rows = recipes.numbered_users(dated).select(*USERS_DATED.columns)
    for half in (rows.filter(F.col("ts") < SPLIT_MS), rows.filter(F.col("ts") >= SPLIT_MS)):
        latest = latest_per_key(half, USERS_DATED.pk, "ts", combine=True)
        upsert_parts(latest, USERS_DATED, base, "ts", name, 8, Audit(min_rows=1))
    kept = work_dir(spark, "users")
    read_parted(spark, USERS_DATED, name).write.parquet(kept)
    drop_table(spark, name)
    return conform(read_target(spark, kept, USERS_DATED), DIM_USERS, USER_NAMES)


def _levels_seen(spark, sf_dir):
    """Dated plays of known users, with the second and the level."""
    known = visits(spark, sf_dir).filter((F.col("userId") != "") & F.col("ts").isNotNull())
    return known.withColumn("start_time", epoch_ms_to_ts("ts"))


@query
def user_level_history(spark, sf_dir):
    """From when to when each user had a level; the rows come in three parts without regard to time, the
    last one twice."""
    base = work_dir(spark, "history")
    seen = recipes.plays(_levels_seen(spark, sf_dir))
    for part in (2, 0, 1, 1):
        rows = seen.filter(F.pmod(F.col("event_id"), F.lit(3)) == part)
        update_history(rows, base, ["userId"], "start_time", ["level"], parts=4)
    return read_history(spark, base)


@query
def level_at_event(spark, sf_dir):
    """Every dated event of a known user with the level of the user's last play up to then."""
    seen = _levels_seen(spark, sf_dir)
    asked = seen.select("event_id", "userId", "start_time")
    return as_of(asked, recipes.plays(seen), ["userId"], "start_time", ["level"])


def _write_json(rows, path, rows_per_file=0):
    """Raw JSON as logs are kept: packed, ten times smaller. A packed file is read by one task, so files are
    what one task has written, which is bounded, and ``rows_per_file`` at most."""
    writer = rows.write.mode("append").option("compression", "gzip")
    with dropping_shuffles(rows.sparkSession):
        writer.option("maxRecordsPerFile", rows_per_file).json(path)


def _log_as_json(spark, sf_dir):
    path = work_dir(spark, "log-json")
    _write_json(log(spark, sf_dir, whole=True), path)
    return path


def _joined_log(spark, sf_dir):
    """The whole log in a folder, so that it is joined once, however often it is read."""
    path = work_dir(spark, "log")
    write_parquet(log(spark, sf_dir, whole=True), path)
    return path


def _log_with_copies(spark, sf_dir, n_batches=4, joined=None):
    """Every line of number 2 twice, in files of which a stream takes an ``n_batches``-th at a time.

    A stream takes files by age: the copies, written after all the rest, come in its last batches, parted
    from what they repeat. There are as many files as tasks that write them, no fewer than batches, and none
    of more than ``LOG_FILE_ROWS`` rows. ``joined`` is a folder of ``_joined_log``, which the caller removes.
    """
    path, whole = work_dir(spark, "log-json"), joined or _joined_log(spark, sf_dir)
    rows = spark.read.schema(STAGING_EVENTS.schema).parquet(whole)
    most = min(LOG_FILE_ROWS, -(-table(spark, sf_dir, "lineitem").count() // n_batches))
    _write_json(rows, path, most)
    _write_json(rows.filter("itemInSession = 2"), path, most)
    if not joined:
        files.remove(spark, whole)
    return path


@query
def stage_roundtrip(spark, sf_dir):
    """The log written as JSON and staged again equals the log."""
    staged = work_dir(spark, "staged")
    stage_json(spark, _log_as_json(spark, sf_dir), staged, STAGING_EVENTS)
    return good_rows(spark.read.parquet(staged)).select(*STAGING_EVENTS.columns)


@query
def stage_append(spark, sf_dir):
    """The catalogue staged twice by appending: every row twice."""
    raw, staged = work_dir(spark, "songs-json"), work_dir(spark, "songs-staged")
    songs(spark, sf_dir).write.json(raw)
    for _ in range(2):
        stage_json(spark, raw, staged, STAGING_SONGS, mode="append", corrupt="fail")
    return spark.read.schema(STAGING_SONGS.schema).parquet(staged)


def _put_json(spark, rows, folder, n=2):
    """``rows`` as ``n`` JSON files of fixed names, replacing those of the same names."""
    aside = work_dir(spark, "json")
    rows.repartition(n).write.json(aside)
    parts = [p for p in files.names(spark, aside) if p.endswith(".json")]
    for k, part in enumerate(parts):
        files.remove(spark, f"{folder}/part-{k}.json")
        files.move(spark, f"{aside}/{part}", f"{folder}/part-{k}.json")


@query
def stage_new_files_(spark, sf_dir):
    """Three arrivals: two folders; one more beside them; one of them replaced, its levels all paid. Files
    seen before are not staged again, and of the replaced ones only the later rows count."""
    raw, staged, ledger = (work_dir(spark, n) for n in ("arrivals", "staged-once", "ledger"))
    rows = visits(spark, sf_dir).select(*VISIT_SPEC.columns)
    third = F.pmod("event_id", F.lit(3))
    arrivals = [
        [("a", rows.filter(third == 0)), ("b", rows.filter(third == 1))],
        [("c", rows.filter(third == 2))],
        [("b", rows.filter(third == 1).withColumn("level", F.lit("paid")))],
    ]
    for arrival in arrivals:
        for name, part in arrival:
            _put_json(spark, part, f"{raw}/{name}")
        stage_new_files(spark, raw, staged, ledger, VISIT_SPEC)
    return read_staged(spark, staged, ledger, VISIT_SPEC)


def _visits_by_day(spark, sf_dir):
    path = work_dir(spark, "visits-json")
    dated = visits(spark, sf_dir)
    dated.select(
        *VISIT_SPEC.columns,
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.day("day").alias("day"),
    ).write.partitionBy("year", "month", "day").json(path)
    return path


@query
def stage_day(spark, sf_dir):
    """Of visits laid out by day, one day's folder staged: a backfill of that day."""
    staged = work_dir(spark, "day-staged")
    stage_json(spark, _visits_by_day(spark, sf_dir), staged, VISIT_SPEC, day=ONE_DAY, day_style="hive")
    return good_rows(spark.read.parquet(staged)).select(*VISIT_SPEC.columns)


@query
def replay_days_(spark, sf_dir):
    """The month staged by day; then the log of days 3 to 5 comes again with all levels paid and day 6 is
    taken back, and days 3 to 6 are replayed, twice."""
    raw, staged = _visits_by_day(spark, sf_dir), work_dir(spark, "days")
    first, last = date(2024, 1, 1), date(2024, 1, 31)
    replay_days(spark, raw, staged, first, last, VISIT_SPEC, "hive")
    again = visits(spark, sf_dir).filter(F.col("day").between("2024-01-03", "2024-01-05"))
    for d in (3, 4, 5, 6):
        files.remove(spark, date_prefix(raw, date(2024, 1, d), "hive"))
    parts = {c: getattr(F, c)("day") for c in ("year", "month", "day")}
    paid = again.withColumns({"level": F.lit("paid"), **parts}).select(*VISIT_SPEC.columns, *parts)
    paid.write.mode("append").partitionBy(*parts).json(raw)
    for _ in range(2):
        replay_days(spark, raw, staged, date(2024, 1, 3), date(2024, 1, 6), VISIT_SPEC, "hive")
    return spark.read.parquet(staged).select(*VISIT_SPEC.columns)


@query
def json_scan(spark, sf_dir):
    """Plays per level, read straight from the JSON of all days with the declared schema."""
    raw = read_json(spark, _visits_by_day(spark, sf_dir), VISIT_SPEC, corrupt="drop")
    return raw.filter(F.col("page") == PLAY_PAGE).groupBy("level").agg(
        F.count(F.lit(1)).alias("n_plays"), F.max("ts").alias("last_ts")
    )


@query
def partition_read(spark, sf_dir):
    """Events written by year/month/day; one folder read back."""
    path = work_dir(spark, "partitioned")
    e = events(spark, sf_dir)
    dated = e.select("*", F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"))
    write_parquet(dated, path, EVENTS_BY_DAY.partition_by)
    return read_target(spark, path, EVENTS_BY_DAY).filter(
        (F.col("year") == ONE_DAY.year) & (F.col("month") == ONE_DAY.month) & (F.col("day") == ONE_DAY.day)
    )


def _raw_files(spark, sf_dir):
    """Both raw sources below one folder, nested as deep as the lake layout expects."""
    root = work_dir(spark, "raw")
    # The lake's globs take names in .json, which a packed file does not have but its folder may.
    _write_json(log(spark, sf_dir, whole=True), f"{root}/log-data/all/all/all.json")
    songs(spark, sf_dir).write.json(f"{root}/song_data/all/all/all")
    return root


@query
def warehouse_load(spark, sf_dir):
    """The whole warehouse load from JSON: rows per step."""
    root, base = _raw_files(spark, sf_dir), work_dir(spark, "warehouse")
    schema = f"wh_{base[-8:]}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{base}/db'")
    report = run_warehouse(spark, f"{root}/log-data", f"{root}/song_data", base, schema=schema)
    for spec in (*WAREHOUSE, *STAGING):
        drop_table(spark, f"{schema}.{spec.name}")
    spark.sql(f"DROP DATABASE {schema}")
    return report.select("step", "inserted")


@query
def warehouse_days(spark, sf_dir):
    """Three days loaded in turn, the second one twice: plays and known seconds of each user."""
    raw, base = work_dir(spark, "raw"), work_dir(spark, "warehouse")
    songs(spark, sf_dir).write.json(f"{raw}/songs")
    # The years of the log stand for three days.
    # They are parted from a copy, so that the log is joined once.
    whole = _joined_log(spark, sf_dir)
    plays = spark.read.parquet(whole)
    ends = [ts_to_epoch_ms(F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz")) for y in (1997, 1999)]
    number = F.when(F.col("ts") < ends[0], 1).when(F.col("ts") < ends[1], 2).otherwise(3)
    for n in (1, 2, 3):
        _write_json(plays.filter(number == n), date_prefix(f"{raw}/log", date(2018, 11, n)))
    files.remove(spark, whole)
    schema = f"wh_{base[-8:]}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{base}/db'")
    for n in (1, 2, 2, 3):
        run_warehouse(spark, f"{raw}/log", f"{raw}/songs", base, date(2018, 11, n), schema)
    kept = (FACT_SONGPLAYS, DIM_USERS, DIM_TIME)
    folders = [(s, table_location(spark, f"{schema}.{s.name}")) for s in kept]
    for spec in (*WAREHOUSE, *STAGING):
        drop_table(spark, f"{schema}.{spec.name}")
    spark.sql(f"DROP DATABASE {schema}")
    fact, users, times = (read_target(spark, folder, spec) for spec, folder in folders)
    per_user = (
        fact.join(times.select("start_time", F.lit(1).alias("known")), "start_time", "left")
        .groupBy(F.col("user_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("n_plays"), F.count("known").alias("n_known"))
    )
    return users.join(per_user, "id", "full")


@query
def lake_load(spark, sf_dir):
    """The whole lake load from JSON, run twice: rows per step of both runs."""
    root, base = _raw_files(spark, sf_dir), work_dir(spark, "lake")
    first, second = run_lake(spark, root, base), run_lake(spark, root, base)
    again = second.select("step", F.col("inserted").alias("inserted_again"))
    return first.select("step", "inserted").join(again, "step")


# --- Streams ---


@query
def stream_stage_equals_batch(spark, sf_dir):
    dest, checkpoint = work_dir(spark, "stream-staged"), work_dir(spark, "stream-state")
    stream_stage(spark, _log_as_json(spark, sf_dir), dest, STAGING_EVENTS, checkpoint).awaitTermination()
    return spark.read.schema(STAGING_EVENTS.schema).parquet(dest)


def _stream_fact_once(spark, sf_dir, raw, dest, n_batches, state=None):
    each = -(-sum(1 for name in files.names(spark, raw) if name.endswith(".json.gz")) // n_batches)
    stream = read_json_stream(spark, raw, STAGING_EVENTS, files_per_trigger=max(1, each))
    state = state or work_dir(spark, "stream-state")
    stream_fact(stream, songs(spark, sf_dir), dest, state, STREAM_KEY, nulls="equal").awaitTermination()
    return read_stream_fact(spark, dest).select(*[c for c in FACT_SONGPLAYS.columns if c != "id"])


@query
def stream_fact_equals_batch(spark, sf_dir):
    """The fact built by a stream over the JSON log in several micro-batches that part equal plays, without
    the id."""
    return _stream_fact_once(spark, sf_dir, _log_with_copies(spark, sf_dir), work_dir(spark, "stream-fact"), 4)


@query
def stream_fact_again(spark, sf_dir):
    """The same after the stream has lost its checkpoint and read every file again, cut otherwise."""
    dest, joined = work_dir(spark, "stream-fact"), _joined_log(spark, sf_dir)
    for n_batches in (4, 2):
        raw = _log_with_copies(spark, sf_dir, n_batches, joined)
        fact = _stream_fact_once(spark, sf_dir, raw, dest, n_batches)
        # The next stream has files of its own, and the fact reads none of them.
        files.remove(spark, raw)
    files.remove(spark, joined)
    return fact


@query
def stream_fact_replayed(spark, sf_dir):
    """The same after the run was killed before its last batch was noted: that batch is run again."""
    raw, dest, state = _log_with_copies(spark, sf_dir, 2), work_dir(spark, "stream-fact"), work_dir(spark, "stream-state")
    _stream_fact_once(spark, sf_dir, raw, dest, 2, state)
    last = max(files.names(spark, f"{state}/commits"), key=int)
    files.remove(spark, f"{state}/commits/{last}")
    return _stream_fact_once(spark, sf_dir, raw, dest, 2, state)


@query
def stream_seconds(spark, sf_dir):
    """Distinct (second, user) of the plays, from files whose times and users are all mixed up."""
    raw, dest = work_dir(spark, "visits-json"), work_dir(spark, "stream-seconds")
    twice = visits(spark, sf_dir).unionByName(visits(spark, sf_dir))
    twice.select(*VISIT_SPEC.columns).repartition(4).write.json(raw)
    seconds = (
        recipes.plays(read_json_stream(spark, raw, VISIT_SPEC, files_per_trigger=1))
        .filter(F.col("ts").isNotNull())
        .select(epoch_ms_to_ts("ts").alias("start_time"), "userId")
    )
    stream_dedup(seconds, dest, SECONDS, work_dir(spark, "stream-state")).awaitTermination()
    return spark.read.schema(SECONDS.schema).parquet(dest)


def _daily_visits(spark, sf_dir):
    """A stream of three arrivals in order of time, of which each but the first repeats the one before."""
    raw = work_dir(spark, "visits-json")
    days = visits(spark, sf_dir).filter(F.col("ts").isNotNull())
    thirds = [F.dayofmonth("day") <= 10, F.dayofmonth("day").between(11, 20), F.dayofmonth("day") > 20]
    # Each arrival is as many files, by the rows of the whole, and they are taken together.
    n_files = 1 + events(spark, sf_dir).count() // DAILY_FILE_ROWS
    for k, third in enumerate(thirds):
        part = days.filter(third | thirds[k - 1] if k else third).select(*VISIT_SPEC.columns)
        _put_json(spark, part, f"{raw}/{k}", n_files)
    stream = recipes.plays(read_json_stream(spark, raw, VISIT_SPEC, files_per_trigger=n_files, corrupt="drop"))
    return stream.select(epoch_ms_to_ts("ts").alias("start_time"), "userId")


@query
def stream_seconds_keyed(spark, sf_dir):
    """Distinct (second, user) of plays that come up to twenty days late and twice, from keyed state."""
    dest, state = work_dir(spark, "stream-keyed"), work_dir(spark, "stream-state")
    stream = _daily_visits(spark, sf_dir)
    keys = ["start_time", "userId"]
    stream_dedup_keyed(stream, keys, "start_time", 86_400, "25 days", dest, state).awaitTermination()
    return spark.read.schema(SECONDS.schema).parquet(dest)


@query
def stream_seconds_within(spark, sf_dir):
    """The same from the state of Spark's deduplication within a watermark."""
    dest, state = work_dir(spark, "stream-within"), work_dir(spark, "stream-state")
    first = stream_dedup_within(_daily_visits(spark, sf_dir), ["start_time", "userId"], "start_time", "25 days")
    writer = first.writeStream.format("parquet").option("path", dest).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(SECONDS.schema).parquet(dest)


def _stream_users(spark, sf_dir, base, name, n_files, parts=None):
    raw, state = work_dir(spark, "visits-json"), work_dir(spark, "stream-state")
    visits(spark, sf_dir).select(*VISIT_SPEC.columns).repartition(n_files).write.json(raw)
    stream = read_json_stream(spark, raw, VISIT_SPEC, files_per_trigger=1)
    known = recipes.numbered_users(recipes.plays(stream).filter(F.col("ts").isNotNull()))
    rows = known.select(*USERS_DATED.columns)
    stream_upsert_latest(rows, USERS_DATED, base, state, "ts", name, parts).awaitTermination()


@query
def stream_users_parts(spark, sf_dir):
    """The latest row of each user, kept by a stream of three micro-batches in a table in parts."""
    base = work_dir(spark, "stream-users")
    name = f"users_{base[-8:]}"
    ensure_parted(spark, USERS_DATED, base, name)
    _stream_users(spark, sf_dir, base, name, 3, 4)
    kept = work_dir(spark, "users")
    read_parted(spark, USERS_DATED, name).write.parquet(kept)
    drop_table(spark, name)
    return conform(read_target(spark, kept, USERS_DATED), DIM_USERS, USER_NAMES)


@query
def stream_users(spark, sf_dir):
    """The latest row of each user, kept by a stream of upserts in two micro-batches."""
    base = work_dir(spark, "stream-users")
    name = f"users_{base[-8:]}"
    ensure_table(spark, USERS_DATED, base, name)
    _stream_users(spark, sf_dir, base, name, 2)
    folder = table_location(spark, name)
    drop_table(spark, name)
    return conform(read_target(spark, folder, USERS_DATED), DIM_USERS, USER_NAMES)
