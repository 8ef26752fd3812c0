"""Table definitions: two staging tables and five star tables, in the names of both layouts.

Spark's Parquet tables enforce neither keys nor NOT NULL, so a ``TableSpec`` carries them for the
operators (dedup, incremental load) and for the checks in ``operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "whole": T.DecimalType(18, 0),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    pk: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def ddl(self) -> str:
        return ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in self.schema
        )

    def retyped(self, name: str | None = None, **types: str) -> TableSpec:
        """The same table with other column types, e.g. ``retyped(duration="whole")``."""
        unknown = set(types) - set(self.columns)
        if unknown:
            raise ValueError(f"{self.name} has no column {sorted(unknown)}")
        fields = [
            T.StructField(f.name, _TYPES[types[f.name]] if f.name in types else f.dataType, f.nullable)
            for f in self.schema
        ]
        return replace(self, name=name or self.name, schema=T.StructType(fields))


def table(
    name: str, columns: str, pk: str = "", partition_by: str = "", not_null: str = "", sort_by: str = ""
) -> TableSpec:
    """``columns`` is ``"name type, ..."``; key columns are implied to be NOT NULL.

    ``partition_by`` are folders, ``sort_by`` orders the rows inside each file.
    """
    required = set(pk.split()) | set(not_null.split())
    fields = []
    for column in columns.split(","):
        field, kind = column.split()
        fields.append(T.StructField(field, _TYPES[kind], field not in required))
    return TableSpec(
        name,
        T.StructType(fields),
        tuple(pk.split()),
        tuple(partition_by.split()),
        tuple(sort_by.split()),
    )


# --- Fixed values: field names and order of the source JSON and of the published tables. ---

# The page that marks a play, and the text that stands in for a missing partition value.
PLAY_PAGE = "NextSong"
MISSING_TEXT = "XXXX"

# userId may be blank in the logs, so staging keeps it as text.
STAGING_EVENTS = table(
    "staging_events",
    "artist string, auth string, firstName string, gender string, itemInSession int, lastName string, "
    "length double, level string, location string, method string, page string, registration double, "
    "sessionId int, song string, status int, ts bigint, userAgent string, userId string",
)
STAGING_SONGS = table(
    "staging_songs",
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, duration double, year int",
)

# Warehouse layout.
FACT_SONGPLAYS = table(
    "fact_songplays",
    "id bigint, start_time timestamp, user_id int, level string, song_id string, artist_id string, "
    "session_id int, location string, user_agent string",
    pk="id",
    not_null="start_time user_id",
    sort_by="start_time",
)
DIM_USERS = table(
    "dim_users", "id int, first_name string, last_name string, gender string, level string", pk="id"
)
DIM_SONGS = table(
    "dim_songs",
    "id string, title string, artist_id string, year int, duration double",
    pk="id",
    not_null="artist_id",
)
DIM_ARTISTS = table(
    "dim_artists", "id string, name string, location string, latitude double, longitude double", pk="id"
)
DIM_TIME = table(
    "dim_time",
    "start_time timestamp, hour int, day int, week int, month int, year int, weekday int",
    pk="start_time",
)

# Lake layout: source names, hive-style partition folders.
LAKE_SONGS = table(
    "songs",
    "song_id string, title string, artist_id string, year string, duration double",
    pk="song_id",
    partition_by="year",
    sort_by="artist_id",
)
# A folder per artist and year, as first published: about one file per artist and year, so for
# catalogues of few artists only. In LAKE_SONGS an artist is found by row-group statistics instead.
LAKE_SONGS_BY_ARTIST = replace(LAKE_SONGS, partition_by=("year", "artist_id"), sort_by=())
LAKE_ARTISTS = table(
    "artists",
    "artist_id string, artist_name string, artist_location string, artist_latitude double, "
    "artist_longitude double",
    pk="artist_id",
)
LAKE_TIME = table(
    "time",
    "start_time timestamp, hour int, day int, week int, month int, year int, weekday string",
    pk="start_time",
    partition_by="year month",
    sort_by="start_time",
)
LAKE_USERS = table(
    "users",
    "userId string, firstName string, lastName string, gender string, level string",
    pk="userId",
)
LAKE_SONGPLAYS = table(
    "songplays",
    "userId string, level string, artist string, song_id string, artist_id string, sessionId int, "
    "location string, userAgent string, start_time timestamp, month int, year int, id bigint",
    pk="id",
    not_null="start_time userId",
    partition_by="year month",
    sort_by="start_time",
)

# Whole-number layout: numeric(18,0) for the fractional columns, text for two calendar parts.
STAGING_EVENTS_WHOLE = STAGING_EVENTS.retyped(length="whole", registration="whole")
STAGING_SONGS_WHOLE = STAGING_SONGS.retyped(
    artist_latitude="whole", artist_longitude="whole", duration="whole"
)
DIM_SONGS_WHOLE = DIM_SONGS.retyped(duration="whole")
DIM_ARTISTS_WHOLE = DIM_ARTISTS.retyped(latitude="whole", longitude="whole")
DIM_TIME_TEXT = DIM_TIME.retyped(month="string", weekday="string")

# --- End of fixed values. ---

STAGING = (STAGING_EVENTS, STAGING_SONGS)
WAREHOUSE = (FACT_SONGPLAYS, DIM_USERS, DIM_SONGS, DIM_ARTISTS, DIM_TIME)
LAKE = (LAKE_SONGS, LAKE_ARTISTS, LAKE_TIME, LAKE_USERS, LAKE_SONGPLAYS)
