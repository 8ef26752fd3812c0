"""The five star tables as plain DataFrame functions, in both layouts.

``log`` has the columns of ``STAGING_EVENTS`` (or the ones a recipe uses), ``songs`` those of
``STAGING_SONGS``. Nothing here runs a job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import calendar_parts, epoch_ms_to_ts
from starmart.operators import (
    conform,
    dedup_by_key,
    distinct_rows,
    enrich,
    impute_missing,
    latest_by_time_join,
    latest_per_key,
    require_finite,
    require_present,
)
from starmart.schemas import (
    DIM_ARTISTS,
    DIM_SONGS,
    DIM_TIME,
    DIM_USERS,
    LAKE_ARTISTS,
    LAKE_SONGPLAYS,
    LAKE_SONGS,
    LAKE_TIME,
    LAKE_USERS,
    MISSING_TEXT,
    PLAY_PAGE,
    TableSpec,
)

# Which log fields identify a song, and how source fields are named in the warehouse.
SONG_MATCH = {"artist": "artist_name", "song": "title", "length": "duration"}
SONG_IDS = ("song_id", "artist_id")
USER_FIELDS = ("firstName", "lastName", "gender", "level")
USER_NAMES = {"id": "userId", "first_name": "firstName", "last_name": "lastName"}
SONG_NAMES = {"id": "song_id"}
ARTIST_NAMES = {
    "id": "artist_id",
    "name": "artist_name",
    "location": "artist_location",
    "latitude": "artist_latitude",
    "longitude": "artist_longitude",
}
PLAY_NAMES = {"user_id": "userId", "session_id": "sessionId", "user_agent": "userAgent"}


def plays(log: DataFrame) -> DataFrame:
    """Log rows of the play page."""
    return log.filter(F.col("page") == PLAY_PAGE)


def _matched(log: DataFrame, songs: DataFrame, **options) -> DataFrame:
    return enrich(log, songs, SONG_MATCH, SONG_IDS, **options).withColumn(
        "start_time", epoch_ms_to_ts("ts")
    )


def numbered_users(log: DataFrame) -> DataFrame:
    """Log rows whose user is a number, with it as one."""
    return require_present(log.withColumn("userId", F.col("userId").try_cast("int")), ["userId"])


def _latest_users(log: DataFrame) -> DataFrame:
    # Names and level seldom change: combining first leaves a few rows per user to rank.
    return latest_per_key(log, ["userId"], "ts", take=USER_FIELDS, combine=True)


def _times(log: DataFrame, weekday: str) -> DataFrame:
    seconds = plays(require_finite(log, ["ts"])).select(epoch_ms_to_ts("ts").alias("start_time"))
    return calendar_parts(distinct_rows(seconds), "start_time", weekday=weekday)


# Warehouse layout


def songplays(log: DataFrame, songs: DataFrame, **options) -> DataFrame:
    """Fact rows without their id: every identified, dated play, with song and artist if known.

    ``options`` go to ``enrich``.
    """
    known = require_finite(require_present(plays(log), ["userId"]), ["ts"])
    matched = _matched(numbered_users(known), songs, **options)
    names = {v: k for k, v in PLAY_NAMES.items()}
    columns = ("start_time", "userId", "level", *SONG_IDS, "sessionId", "location", "userAgent")
    return matched.select(*[F.col(c).alias(names.get(c, c)) for c in columns])


def users(log: DataFrame, spec: TableSpec = DIM_USERS) -> DataFrame:
    """One row per user: name and level at the last play.

    The user's text becomes a number before the latest row is taken: "8" and "08" are one user.
    """
    known = require_finite(require_present(plays(log), ["userId"]), ["ts"])
    return conform(_latest_users(numbered_users(known)), spec, USER_NAMES)


def users_by_time(log: DataFrame) -> DataFrame:
    """The literal warehouse text: attributes of whatever happened at each user's last play."""
    found = latest_by_time_join(
        log, "userId", "ts", USER_FIELDS, of=require_present(plays(log), ["userId"], blank_ok=True)
    )
    return found.withColumnsRenamed({v: k for k, v in USER_NAMES.items()})


def songs_all(songs: DataFrame, spec: TableSpec = DIM_SONGS) -> DataFrame:
    """Distinct song rows: an id with varying attributes keeps several rows."""
    return distinct_rows(
        conform(require_present(songs, SONG_IDS, blank_ok=True), spec, SONG_NAMES)
    )


def songs(songs_log: DataFrame, spec: TableSpec = DIM_SONGS) -> DataFrame:
    """One row per song id."""
    rows = conform(require_present(songs_log, SONG_IDS), spec, SONG_NAMES)
    return dedup_by_key(rows, spec.pk, combine=True)


def artists_all(songs: DataFrame, spec: TableSpec = DIM_ARTISTS) -> DataFrame:
    """Distinct artist rows: an id with varying attributes keeps several rows."""
    return distinct_rows(
        conform(require_present(songs, ["artist_id"], blank_ok=True), spec, ARTIST_NAMES)
    )


def artists(songs: DataFrame, spec: TableSpec = DIM_ARTISTS) -> DataFrame:
    """One row per artist id."""
    rows = conform(require_present(songs, ["artist_id"]), spec, ARTIST_NAMES)
    return dedup_by_key(rows, spec.pk, combine=True)


def times(log: DataFrame, spec: TableSpec = DIM_TIME, weekday: str = "sun0") -> DataFrame:
    """One row per second with a play."""
    return conform(_times(log, weekday), spec)


# Lake layout


def lake_songs(songs_log: DataFrame) -> DataFrame:
    kept = require_present(songs_log.select(*LAKE_SONGS.columns), SONG_IDS)
    return impute_missing(dedup_by_key(kept, LAKE_SONGS.pk, combine=True), ["year"], MISSING_TEXT)


def lake_artists(songs_log: DataFrame) -> DataFrame:
    rows = require_present(songs_log.select(*LAKE_ARTISTS.columns), ["artist_id"])
    return dedup_by_key(rows, LAKE_ARTISTS.pk, combine=True)


def lake_times(log: DataFrame) -> DataFrame:
    return conform(_times(log, "iso"), LAKE_TIME)


def lake_users(log: DataFrame, latest: bool = True) -> DataFrame:
    """Users of every page: the latest row of each, or all distinct rows."""
    if latest:
        return _latest_users(log).select(*LAKE_USERS.columns)
    return distinct_rows(log, LAKE_USERS.columns)


def lake_songplays(
    log: DataFrame,
    songs: DataFrame,
    keep_undated: bool = False,
    unloaded: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> DataFrame:
    """Fact rows without their id; ``keep_undated`` lets plays without a time through.

    ``unloaded`` gets the plays with their time and leaves out some of them before songs are looked up.
    """
    known = require_present(plays(log), ["userId"])
    if not keep_undated:
        known = require_finite(known, ["ts"])
    if unloaded:
        timed = calendar_parts(known.withColumn("start_time", epoch_ms_to_ts("ts")), "start_time", ("month", "year"))
        known = unloaded(timed).select(*log.columns)
    matched = _matched(known, songs, **options)
    dated = calendar_parts(matched, "start_time", ("month", "year"))
    return dated.select(*[c for c in LAKE_SONGPLAYS.columns if c not in LAKE_SONGPLAYS.pk])
