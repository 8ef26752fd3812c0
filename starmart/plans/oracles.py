"""DuckDB SQL for the registered queries, written independently of the Spark plans."""

from __future__ import annotations

LOG = """
  SELECT p_brand AS artist, o_orderstatus AS auth, c_name AS "firstName",
         substr(c_mktsegment, 1, 1) AS gender, l_linenumber AS "itemInSession",
         c_mktsegment AS "lastName",
         CASE WHEN l_linenumber = 7 THEN p_retailprice + 0.5 ELSE p_retailprice END AS length,
         CASE WHEN l_quantity >= 25 THEN 'paid' ELSE 'free' END AS level, n_name AS location,
         CASE WHEN l_linestatus = 'O' THEN 'PUT' ELSE 'GET' END AS method,
         CASE WHEN l_returnflag = 'R' THEN 'Home' ELSE 'NextSong' END AS page,
         c_acctbal AS registration, CAST(l_suppkey AS INTEGER) AS "sessionId", p_name AS song,
         p_size AS status,
         CASE WHEN o_orderstatus <> 'P' THEN epoch_us(o_orderdate) // 1000
              + CAST(round(l_extendedprice * 100) AS BIGINT) END AS ts,
         o_orderpriority AS "userAgent",
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
              ELSE CAST(o_custkey AS VARCHAR) END AS "userId"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey"""

VISITS = """
  SELECT event_id,
         CASE WHEN value < 5 THEN '' ELSE CAST(user_id AS VARCHAR) END AS "userId",
         c_name AS "firstName", c_mktsegment AS "lastName", substr(c_mktsegment, 1, 1) AS gender,
         CASE WHEN value >= 30 THEN 'paid' ELSE 'free' END AS level,
         CASE WHEN event_type IN ('view', 'click') THEN 'NextSong' ELSE event_type END AS page,
         CASE WHEN props <> '{"k": 0}' THEN epoch_us(ts) // 1000 END AS ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS "sessionId",
         n_name AS location, props AS "userAgent", CAST(ts AS DATE) AS day
  FROM events
  JOIN customer ON user_id = c_custkey
  JOIN nation ON c_nationkey = n_nationkey"""

SONGS = """
  SELECT 1 AS num_songs, p_brand AS artist_id, CAST(p_size AS DOUBLE) AS artist_latitude,
         -CAST(p_size AS DOUBLE) AS artist_longitude, p_type AS artist_location,
         p_brand AS artist_name, CAST(p_partkey AS VARCHAR) AS song_id, p_name AS title,
         p_retailprice AS duration, p_size AS "year"
  FROM part"""

SONG_FEED = """
  SELECT CASE WHEN l_discount < 0.1 THEN p_brand ELSE '' END AS artist_id,
         CAST(n_nationkey AS DOUBLE) AS artist_latitude,
         CAST(n_regionkey AS DOUBLE) AS artist_longitude, n_name AS artist_location,
         p_brand AS artist_name, CAST(l_partkey AS VARCHAR) AS song_id, p_name AS title,
         p_retailprice AS duration,
         CASE WHEN l_linestatus = 'O' THEN CAST(year(l_shipdate) AS INTEGER) END AS "year"
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey"""

LISTED = """
  SELECT l_orderkey, l_linenumber, p_brand AS artist, p_name AS song,
         CASE WHEN l_linenumber = 7 THEN p_retailprice + 0.5 ELSE p_retailprice END AS length
  FROM lineitem JOIN part ON l_partkey = p_partkey"""

SOURCES = {"log": LOG, "visits": VISITS, "songs": SONGS, "song_feed": SONG_FEED, "listed": LISTED}


def _with(names: str, body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({SOURCES[n]})" for n in names.split()) + body


SECOND = "make_timestamp(ts // 1000 * 1000000)"
MATCH = "l.artist = s.artist_name AND l.song = s.title AND l.length = s.duration"
MATCH_WHOLE = (
    "l.artist = s.artist_name AND l.song = s.title "
    "AND CAST(l.length AS DECIMAL(18,0)) = CAST(s.duration AS DECIMAL(18,0))"
)
KNOWN_PLAY = """page = 'NextSong' AND "userId" <> '' AND ts IS NOT NULL"""


def _songplays(match: str = MATCH, catalogue: str = "songs", where: str = "") -> str:
    return _with(
        "log songs",
        f"""
        SELECT {SECOND} AS start_time, CAST("userId" AS INTEGER) AS user_id, level, song_id,
               artist_id, "sessionId" AS session_id, l.location, "userAgent" AS user_agent
        FROM log l LEFT JOIN {catalogue} s ON {match}
        WHERE {KNOWN_PLAY} {where}""",
    )


def _lake_songplays(where: str) -> str:
    return _with(
        "log songs",
        f"""
        SELECT "userId", level, artist, song_id, artist_id, "sessionId", l.location, "userAgent",
               {SECOND} AS start_time, CAST(month({SECOND}) AS INTEGER) AS month,
               CAST(year({SECOND}) AS INTEGER) AS "year"
        FROM log l LEFT JOIN songs s ON {MATCH}
        WHERE page = 'NextSong' AND "userId" <> '' {where}""",
    )


def _first(select: str, source: str, key: str, order: str, where: str) -> str:
    return _with(
        source,
        f"""
        SELECT {select} FROM (
          SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
          FROM {source} WHERE {where}) WHERE rn = 1""",
    )


USER_ORDER = 'ts DESC NULLS LAST, "firstName", "lastName", gender, level'
USER_COLUMNS = 'CAST("userId" AS INTEGER) AS id, "firstName" AS first_name, "lastName" AS last_name, gender, level'
ARTIST_COLUMNS = (
    "artist_id AS id, artist_name AS name, artist_location AS location, "
    "artist_latitude AS latitude, artist_longitude AS longitude"
)
FEED_SONG_ORDER = 'title, artist_id, "year" NULLS LAST, duration'
FEED_ARTIST_ORDER = "artist_name, artist_location, artist_latitude, artist_longitude"

USERS_LATEST = _first(USER_COLUMNS, "visits", '"userId"', USER_ORDER, KNOWN_PLAY)


def _times(source: str, weekday: str, kind: str = "INTEGER", weekday_kind: str = "INTEGER") -> str:
    return _with(
        source,
        f"""
        SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour,
               CAST(day(start_time) AS INTEGER) AS day, CAST(week(start_time) AS INTEGER) AS week,
               CAST(month(start_time) AS {kind}) AS month, CAST(year(start_time) AS INTEGER) AS "year",
               CAST({weekday}(start_time) AS {weekday_kind}) AS weekday
        FROM (SELECT DISTINCT {SECOND} AS start_time FROM {source}
              WHERE page = 'NextSong' AND ts IS NOT NULL)""",
    )


EVENT_COLUMNS = "e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props"
KIND = "nullif(event_type, 'error')"


def _new_text(fmt: str) -> str:
    key = f"strftime(date_trunc('hour', ts), '{fmt}') || CAST(user_id AS VARCHAR)"
    return f"""
        SELECT {EVENT_COLUMNS}, date_trunc('hour', ts) AS hour_start, {key} AS text_key
        FROM events e
        WHERE {key} NOT IN (SELECT {key} FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00')"""


TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _counts(extra: str = "") -> str:
    each = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLE_NAMES)
    return f"SELECT table_name, n_rows{extra} FROM ({each})"


DAY_3 = "CAST(ts AS DATE) = DATE '2024-01-03'"
VISIT_COLUMNS = (
    'event_id, "userId", "firstName", "lastName", gender, level, page, ts, "sessionId", location, '
    '"userAgent"'
)
LOG_ROWS = _with("log", " SELECT * FROM log")
SONG_ROWS = _with("songs", " SELECT * FROM songs")

NEW_EVENTS = f"""
    SELECT {EVENT_COLUMNS} FROM events e
    WHERE event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15')"""
SECONDS = _with(
    "visits",
    f""" SELECT DISTINCT {SECOND} AS start_time, "userId" FROM visits
    WHERE page = 'NextSong' AND ts IS NOT NULL""",
)
COPIED_PLAYS = f"""SELECT * FROM ({_songplays()})
    UNION ALL SELECT * FROM ({_songplays(where='AND "itemInSession" = 2')})"""

ORACLES: dict[str, str] = {
    "songplays_fact": _songplays(),
    "songplays_unmatched": _songplays(where="AND song_id IS NULL"),
    "songplays_keep_null_ts": _lake_songplays(""),
    "songplays_lake": _lake_songplays("AND ts IS NOT NULL"),
    "songplays_rounded": _songplays(MATCH_WHOLE),
    "songplays_whole": _songplays(MATCH_WHOLE),
    "songplays_first_match": _songplays(
        MATCH_WHOLE,
        """(SELECT * FROM (SELECT *, row_number() OVER (
              PARTITION BY artist_name, title, CAST(duration AS DECIMAL(18,0))
              ORDER BY song_id, artist_id) AS rn FROM songs) WHERE rn = 1)""",
    ),
    "songplays_bulk": _with(
        "listed songs",
        f" SELECT l.*, song_id, artist_id FROM listed l LEFT JOIN songs s ON {MATCH}",
    ),
    "songplays_tolerant": _with(
        "listed songs",
        """ SELECT l.*, song_id, artist_id FROM listed l LEFT JOIN songs s
        ON l.artist = s.artist_name AND l.song = s.title AND abs(l.length - s.duration) <= 0.5""",
    ),
    "songplays_tolerant_salted": _with(
        "listed songs",
        """ SELECT l.*, song_id, artist_id FROM listed l LEFT JOIN songs s
        ON l.artist = s.artist_name AND abs(l.length - s.duration) <= 0.05""",
    ),
    "songplays_by_artist_salted": _with(
        "listed songs",
        """
        SELECT l.*, name, location FROM listed l LEFT JOIN (
          SELECT artist_id, artist_name AS name, artist_location AS location, row_number() OVER (
            PARTITION BY artist_id
            ORDER BY artist_name, artist_location, artist_latitude, artist_longitude) AS rn
          FROM songs) ON artist = artist_id AND rn = 1""",
    ),
    "songs_dim": _first(
        'song_id AS id, title, artist_id, "year", duration',
        "song_feed", "song_id", FEED_SONG_ORDER, "artist_id <> ''",
    ),
    "songs_distinct": _with(
        "song_feed",
        ' SELECT DISTINCT song_id AS id, title, artist_id, "year", duration FROM song_feed',
    ),
    "songs_lake": _first(
        "song_id, title, artist_id, coalesce(CAST(\"year\" AS VARCHAR), 'XXXX') AS \"year\", duration",
        "song_feed", "song_id", FEED_SONG_ORDER, "artist_id <> ''",
    ),
    "songs_whole": _with(
        "songs",
        """ SELECT song_id AS id, title, artist_id, "year",
               CAST(CAST(duration AS DECIMAL(18,0)) AS BIGINT) AS duration FROM songs""",
    ),
    "artists_dim": _first(ARTIST_COLUMNS, "song_feed", "artist_id", FEED_ARTIST_ORDER, "artist_id <> ''"),
    "artists_lake": _first(
        "artist_id, artist_name, artist_location, artist_latitude, artist_longitude",
        "song_feed", "artist_id", FEED_ARTIST_ORDER, "artist_id <> ''",
    ),
    "artists_distinct": _with("song_feed", f" SELECT DISTINCT {ARTIST_COLUMNS} FROM song_feed"),
    "users_latest": USERS_LATEST,
    "users_lake": _first(
        '"userId", "firstName", "lastName", gender, level', "visits", '"userId"', USER_ORDER, "TRUE"
    ),
    "users_distinct": _with(
        "visits", ' SELECT DISTINCT "userId", "firstName", "lastName", gender, level FROM visits'
    ),
    "users_by_time_join": _with(
        "visits",
        """, last AS (
          SELECT "userId" AS id, max(ts) AS max_ts FROM visits WHERE page = 'NextSong' GROUP BY "userId")
        SELECT id, "firstName" AS first_name, "lastName" AS last_name, gender, level
        FROM last JOIN visits ON max_ts = ts WHERE id IS NOT NULL""",
    ),
    "latest_order_tiebreak": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
          SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1""",
    "user_max_ts": _with(
        "visits",
        """ SELECT "userId", max(ts) AS max_ts FROM visits WHERE page = 'NextSong' GROUP BY "userId\"""",
    ),
    "time_dim_iso": _times("visits", "isodow"),
    "time_dim_sun0": _times("visits", "dayofweek"),
    "time_dim_text": _times("visits", "dayofweek", "VARCHAR", "VARCHAR"),
    "time_lake": _times("visits", "isodow", "INTEGER", "VARCHAR"),
    "time_dim_log": _times("log", "dayofweek"),
    "time_dim_seconds": _with(
        "log",
        """ SELECT count(DISTINCT ts) AS n_ms, count(DISTINCT ts // 1000) AS n_seconds
        FROM log WHERE page = 'NextSong'""",
    ),
    "new_by_key": NEW_EVENTS,
    "new_by_filter": NEW_EVENTS,
    "new_by_bucketed_target": NEW_EVENTS,
    "new_by_key_nulls": f"""
        SELECT {EVENT_COLUMNS}, {KIND} AS kind FROM events e
        WHERE {KIND} NOT IN (SELECT event_type FROM events WHERE event_type = 'click')""",
    "new_by_empty_target": f"""
        SELECT {EVENT_COLUMNS}, {KIND} AS kind FROM events e
        WHERE {KIND} NOT IN (SELECT {KIND} FROM events WHERE ts IS NULL)""",
    "new_by_composed_key_12h": _new_text("%Y-%m-%d-%I-%M-%S"),
    "new_by_composed_key_24h": _new_text("%Y-%m-%d-%H-%M-%S"),
    "new_by_typed_key": f"""
        SELECT {EVENT_COLUMNS}, date_trunc('hour', ts) AS hour_start FROM events e
        WHERE NOT EXISTS (
          SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '2024-01-15 12:00:00'
          AND t.user_id = e.user_id AND date_trunc('hour', t.ts) = date_trunc('hour', e.ts))""",
    "merged_latest": _first(
        '"userId", "firstName", "lastName", gender, level, ts',
        "visits", '"userId"', USER_ORDER, """"userId" <> '' AND ts IS NOT NULL""",
    ),
    "epoch_seconds": """
        SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, epoch_us(ts) // 1000000 AS epoch_s,
               date_trunc('second', ts) AS start_time, date_trunc('millisecond', ts) AS start_time_ms
        FROM events""",
    "impute_partition_cols": _with(
        "visits",
        """ SELECT event_id, CASE WHEN "userId" = '' THEN 'XXXX' ELSE "userId" END AS "userId",
               coalesce(CAST(ts AS VARCHAR), 'XXXX') AS ts FROM visits""",
    ),
    "conform_users": _with(
        "visits",
        """ SELECT DISTINCT TRY_CAST("userId" AS INTEGER) AS id, "firstName" AS first_name,
               "lastName" AS last_name, gender, level FROM visits""",
    ),
    "hash_ids": _with(
        "visits",
        """ SELECT count(*) AS n_keys, count(*) AS n_ids
        FROM (SELECT DISTINCT "userId", ts, "sessionId" FROM visits)""",
    ),
    "hash_key_repeats": """
        SELECT event_type, count(*) AS n_rows, TRUE AS same FROM events GROUP BY event_type""",
    "sequence_ids": f"""
        SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS lowest, count(*) AS highest
        FROM ({_songplays()})""",
    "sequence_ids_ordered": """
        SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id
        FROM orders""",
    "monotonic_ids": f"SELECT count(*) AS n_rows, count(*) AS n_ids FROM ({_songplays()})",
    "row_counts": _counts(),
    "min_rows_check": _counts(", n_rows >= 100 AS ok"),
    "pk_violations": _with(
        "song_feed",
        f""" SELECT id, count(*) AS n_rows FROM (SELECT DISTINCT {ARTIST_COLUMNS} FROM song_feed)
        GROUP BY id HAVING count(*) > 1""",
    ),
    "null_counts": _with(
        "log",
        """ SELECT count(*) FILTER (ts IS NULL) AS ts,
               count(*) FILTER ("userId" IS NULL OR "userId" = '') AS "userId",
               count(*) FILTER (song IS NULL OR song = '') AS song FROM log""",
    ),
    "preview": _with("visits", f" SELECT {VISIT_COLUMNS} FROM visits ORDER BY event_id LIMIT 10"),
    "load_twice_counts": """
        WITH n AS (SELECT count(*) AS everything,
                          count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS early FROM events)
        SELECT 1 AS load, early AS inserted, CAST(0 AS BIGINT) AS skipped FROM n
        UNION ALL SELECT 2, everything - early, early FROM n
        UNION ALL SELECT 3, 0, everything FROM n""",
    "load_fact_twice": _songplays(),
    "load_fact_pruned": _lake_songplays("AND ts IS NOT NULL"),
    "audited_load": f"""
        SELECT {EVENT_COLUMNS}, CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day, 2 AS refused FROM events e""",
    "fact_ids_over_loads": _with(
        "log songs",
        f""" SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS first_id,
               count(*) AS last_id FROM log l LEFT JOIN songs s ON {MATCH} WHERE {KNOWN_PLAY}""",
    ),
    "fact_ids_reserved": _with(
        "log songs",
        f""" SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_outside, TRUE AS small_gaps
        FROM log l LEFT JOIN songs s ON {MATCH} WHERE {KNOWN_PLAY}""",
    ),
    "fact_hash_ids": _with(
        "log songs",
        f""" SELECT 2 * count(*) AS n_rows, 2 * count(*) AS n_ids
        FROM log l LEFT JOIN songs s ON {MATCH} WHERE {KNOWN_PLAY}""",
    ),
    "append_insert": f"""
        SELECT id, name, location, CAST(latitude AS BIGINT) AS latitude,
               CAST(longitude AS BIGINT) AS longitude
        FROM ({_first(ARTIST_COLUMNS, "song_feed", "artist_id", FEED_ARTIST_ORDER, "artist_id <> ''")})""",
    "dimension_refresh": _with(
        "visits",
        f"""
        , early AS (
          SELECT {USER_COLUMNS} FROM (
            SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY {USER_ORDER}) AS rn
            FROM visits WHERE {KNOWN_PLAY} AND ts < epoch_ms(TIMESTAMP '2024-01-15')) WHERE rn = 1),
        everyone AS (
          SELECT {USER_COLUMNS} FROM (
            SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY {USER_ORDER}) AS rn
            FROM visits WHERE {KNOWN_PLAY}) WHERE rn = 1)
        SELECT * FROM early
        UNION ALL SELECT * FROM everyone WHERE id NOT IN (SELECT id FROM early)""",
    ),
    "user_level_history": _with(
        "visits",
        f"""
        , seen AS (
          SELECT "userId", {SECOND} AS start_time, min(level) AS level FROM visits WHERE {KNOWN_PLAY} GROUP BY ALL),
        changed AS (
          SELECT * FROM seen
          QUALIFY lag(level) OVER (PARTITION BY "userId" ORDER BY start_time) IS DISTINCT FROM level)
        SELECT "userId", level, start_time AS valid_from,
               lead(start_time) OVER (PARTITION BY "userId" ORDER BY start_time) AS valid_to
        FROM changed""",
    ),
    "level_at_event": _with(
        "visits",
        f"""
        , seen AS (
          SELECT "userId", {SECOND} AS start_time, min(level) AS level FROM visits WHERE {KNOWN_PLAY} GROUP BY ALL),
        asked AS (
          SELECT event_id, "userId", {SECOND} AS start_time FROM visits WHERE "userId" <> '' AND ts IS NOT NULL)
        SELECT a.event_id, a."userId", a.start_time, s.level
        FROM asked a ASOF LEFT JOIN seen s ON a."userId" = s."userId" AND a.start_time >= s.start_time""",
    ),
    "upsert_users": USERS_LATEST,
    "stage_roundtrip": LOG_ROWS,
    "stage_append": _with("songs", " SELECT * FROM songs UNION ALL SELECT * FROM songs"),
    "stage_new_files": _with(
        "visits",
        f""" SELECT * REPLACE (CASE WHEN event_id % 3 = 1 THEN 'paid' ELSE level END AS level)
        FROM (SELECT {VISIT_COLUMNS} FROM visits)""",
    ),
    "stage_day": _with(
        "visits", f" SELECT {VISIT_COLUMNS} FROM visits WHERE day = DATE '2024-01-03'"
    ),
    "replay_days": _with(
        "visits",
        f""" SELECT * EXCLUDE (d) REPLACE (CASE WHEN d BETWEEN 3 AND 5 THEN 'paid' ELSE level END AS level)
        FROM (SELECT {VISIT_COLUMNS}, day(day) AS d FROM visits) WHERE d <> 6""",
    ),
    "json_scan": _with(
        "visits",
        """ SELECT level, count(*) AS n_plays, max(ts) AS last_ts
        FROM visits WHERE page = 'NextSong' GROUP BY level""",
    ),
    "partition_read": f"""
        SELECT {EVENT_COLUMNS}, CAST(year(ts) AS INTEGER) AS "year",
               CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
        FROM events e WHERE {DAY_3}""",
    "warehouse_load": _with(
        "log songs",
        f"""
        SELECT 'staging_events' AS step, count(*) AS inserted FROM log
        UNION ALL SELECT 'staging_songs', count(*) FROM songs
        UNION ALL SELECT 'fact_songplays', count(*) FROM log l LEFT JOIN songs s ON {MATCH}
          WHERE {KNOWN_PLAY}
        UNION ALL SELECT 'dim_artists', count(DISTINCT artist_id) FROM songs
        UNION ALL SELECT 'dim_songs', count(DISTINCT song_id) FROM songs
        UNION ALL SELECT 'dim_time', count(DISTINCT ts // 1000) FROM log WHERE page = 'NextSong'
        UNION ALL SELECT 'dim_users', count(DISTINCT "userId") FROM log WHERE {KNOWN_PLAY}""",
    ),
    "warehouse_days": _with(
        "log songs",
        f"""
        , known AS (
          SELECT {USER_COLUMNS} FROM (
            SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY {USER_ORDER}) AS rn
            FROM log WHERE {KNOWN_PLAY}) WHERE rn = 1),
        played AS (
          SELECT CAST("userId" AS INTEGER) AS id, count(*) AS n_plays, count(*) AS n_known
          FROM log l LEFT JOIN songs s ON {MATCH} WHERE {KNOWN_PLAY} GROUP BY "userId")
        SELECT id, first_name, last_name, gender, level, n_plays, n_known
        FROM known FULL JOIN played USING (id)""",
    ),
    "lake_load": _with(
        "log songs",
        f"""
        SELECT 'staging songs' AS step, count(*) AS inserted, count(*) AS inserted_again FROM songs
        UNION ALL SELECT 'staging log', count(*), count(*) FROM log
        UNION ALL SELECT 'songs', count(DISTINCT song_id), 0 FROM songs
        UNION ALL SELECT 'artists', count(DISTINCT artist_id), 0 FROM songs
        UNION ALL SELECT 'time', count(DISTINCT ts // 1000), 0 FROM log WHERE page = 'NextSong'
        UNION ALL SELECT 'users', count(DISTINCT "userId"), 0 FROM log
        UNION ALL SELECT 'songplays', count(*), 0 FROM log l LEFT JOIN songs s ON {MATCH}
          WHERE {KNOWN_PLAY}""",
    ),
    "stream_stage_equals_batch": LOG_ROWS,
    "stream_fact_equals_batch": COPIED_PLAYS,
    "stream_fact_again": COPIED_PLAYS,
    "stream_fact_replayed": COPIED_PLAYS,
    "stream_seconds": SECONDS,
    "stream_seconds_keyed": SECONDS,
    "stream_seconds_within": SECONDS,
    "stream_users": USERS_LATEST,
    "stream_users_parts": USERS_LATEST,
    "upsert_users_parts": USERS_LATEST,
}
