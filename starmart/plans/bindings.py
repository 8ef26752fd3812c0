"""The given tables in the shape of the song catalogue and the event log.

The tables hold no nulls or blanks, so some values are turned into missing ones, by content.
Every row of every table used takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.functions import ts_to_epoch_ms
from starmart.schemas import PLAY_PAGE, STAGING_EVENTS, STAGING_SONGS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from a file footer once per process."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def log(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """One log row per order line: the customer plays the part.

    Lines with a pending order have no time, orders of unspecified priority no user, and every
    seventh line number a length half a unit off, so that it finds no song.

    ``whole`` is for those who take every row and column: orders, which add most to a row, are joined last.
    Otherwise they come first, since it is by them that most rows are left out.
    """
    lines, orders, customers, nations, parts = (
        table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "part")
    )
    # What an order adds is joined once per order, and the lines, the most rows by far, are dealt twice.
    # Of a line only what the log takes is dealt, its three marks as one number.
    marks = [F.col("l_quantity") >= 25, F.col("l_linestatus") == "O", F.col("l_returnflag") == "R"]
    paid, put, home = (1 << k for k in range(3))
    lines = lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("since_midnight"),
        sum((F.when(mark, 1 << k).otherwise(0) for k, mark in enumerate(marks)), F.lit(0)).alias("marks"),
    )
    ordered = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    of_order, of_part = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    joined = lines.join(parts, of_part).join(ordered, of_order) if whole else lines.join(ordered, of_order).join(parts, of_part)

    def marked(bit: int):
        return F.col("marks").bitwiseAND(bit) != 0

    columns = {
        "artist": F.col("p_brand"),
        "auth": F.col("o_orderstatus"),
        "firstName": F.col("c_name"),
        "gender": F.substring("c_mktsegment", 1, 1),
        "itemInSession": F.col("l_linenumber"),
        "lastName": F.col("c_mktsegment"),
        "length": F.col("p_retailprice") + F.when(F.col("l_linenumber") == 7, 0.5).otherwise(0.0),
        "level": F.when(marked(paid), "paid").otherwise("free"),
        "location": F.col("n_name"),
        "method": F.when(marked(put), "PUT").otherwise("GET"),
        "page": F.when(marked(home), "Home").otherwise(PLAY_PAGE),
        "registration": F.col("c_acctbal"),
        "sessionId": F.col("l_suppkey").cast("int"),
        "song": F.col("p_name"),
        "status": F.col("p_size"),
        "ts": F.when(F.col("o_orderstatus") != "P", ts_to_epoch_ms("o_orderdate") + F.col("since_midnight")),
        "userAgent": F.col("o_orderpriority"),
        "userId": F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(
            F.col("o_custkey").cast("string")
        ),
    }
    return joined.select(*[columns[c].alias(c) for c in STAGING_EVENTS.columns])


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, with the user's fields; ``day`` is the event's date.

    Small-value events are anonymous and those with payload ``{"k": 0}`` have no time.
    """
    events, customers, nations = (table(spark, sf_dir, t) for t in ("events", "customer", "nation"))
    joined = events.join(customers, F.col("user_id") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        "event_id",
        F.when(F.col("value") < 5, "").otherwise(F.col("user_id").cast("string")).alias("userId"),
        F.col("c_name").alias("firstName"),
        F.col("c_mktsegment").alias("lastName"),
        F.substring("c_mktsegment", 1, 1).alias("gender"),
        F.when(F.col("value") >= 30, "paid").otherwise("free").alias("level"),
        F.when(F.col("event_type").isin("view", "click"), PLAY_PAGE)
        .otherwise(F.col("event_type"))
        .alias("page"),
        F.when(F.col("props") != '{"k": 0}', ts_to_epoch_ms("ts")).alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("sessionId"),
        F.col("n_name").alias("location"),
        F.col("props").alias("userAgent"),
        F.to_date("ts").alias("day"),
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The song catalogue: one row per part."""
    parts = table(spark, sf_dir, "part")
    columns = {
        "num_songs": F.lit(1),
        "artist_id": F.col("p_brand"),
        "artist_latitude": F.col("p_size").cast("double"),
        "artist_longitude": -F.col("p_size").cast("double"),
        "artist_location": F.col("p_type"),
        "artist_name": F.col("p_brand"),
        "song_id": F.col("p_partkey").cast("string"),
        "title": F.col("p_name"),
        "duration": F.col("p_retailprice"),
        "year": F.col("p_size"),
    }
    return parts.select(*[columns[c].alias(c) for c in STAGING_SONGS.columns])


def song_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw feed with many rows per song: one per order line, listed by the line's supplier.

    Location and year vary between the rows of one artist or song; the deepest discounts come
    without an artist id.
    """
    lines, parts, suppliers, nations = (
        table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation")
    )
    joined = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    columns = {
        "num_songs": F.lit(1),
        "artist_id": F.when(F.col("l_discount") < 0.1, F.col("p_brand")).otherwise(""),
        "artist_latitude": F.col("n_nationkey").cast("double"),
        "artist_longitude": F.col("n_regionkey").cast("double"),
        "artist_location": F.col("n_name"),
        "artist_name": F.col("p_brand"),
        "song_id": F.col("l_partkey").cast("string"),
        "title": F.col("p_name"),
        "duration": F.col("p_retailprice"),
        "year": F.when(F.col("l_linestatus") == "O", F.year("l_shipdate")),
    }
    return joined.select(*[columns[c].alias(c) for c in STAGING_SONGS.columns])
