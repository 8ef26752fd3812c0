"""Deduplication in keyed state: what has been seen is remembered per key, and forgotten on a timer.

Nothing is compared with the output, so a batch costs as much as its rows whatever has been written.
State lives in RocksDB next to each task and in the checkpoint, one entry per key that was seen less
than ``keep`` ago; keys spread over the shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TIME, MILLIS = "__event_time", "__event_ms"


def _first_of_key(columns: Sequence[str], keep_ms: int):
    """The processor, made here so that it travels by value: workers need not have this library."""
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    names = list(columns)

    class FirstOfKey(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.seen = handle.getValueState("seen", "until bigint")

        def handleInputRows(self, key, rows, timerValues):
            if self.seen.exists():
                return
            # One pass, one row in memory: the earliest, then the lowest by its text.
            first = min(rows, key=lambda r: (r[MILLIS], repr(r)), default=None)
            if first is None:
                return
            until = first[MILLIS] + keep_ms
            self.seen.update((until,))
            self.handle.registerTimer(until)
            yield Row(*names)(*[first[c] for c in names])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.seen.clear()
            return iter(())

        def close(self):
            pass

    return FirstOfKey()


def stream_dedup_keyed(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    keep_seconds: int,
    delay: str,
    dest: str,
    checkpoint: str,
) -> StreamingQuery:
    """Append the first row of each key to ``dest``, then none of that key until it is forgotten.

    A key is forgotten once the watermark, the latest time seen less ``delay``, has passed its row's time
    by ``keep_seconds``; the next row of the key counts as new. Of several rows in one micro-batch the
    earliest by ``ts`` counts, then the lowest. Rows behind the watermark are dropped, as are rows without
    ``ts``; a null in the key is a value like any other. ``stream_dedup`` forgets and drops nothing, for the
    price of reading its output.
    """
    spark: SparkSession = stream.sparkSession
    columns = stream.columns
    zoned = F.col(ts).cast("timestamp")
    timed = stream.filter(F.col(ts).isNotNull()).withColumns({TIME: zoned, MILLIS: F.unix_millis(zoned)})
    processor = _first_of_key(columns, 1000 * keep_seconds)
    first = (
        timed.withWatermark(TIME, delay)
        .groupBy(*keys)
        .transformWithState(processor, stream.schema, outputMode="append", timeMode="eventTime")
    )
    before = spark.conf.get(PROVIDER_CONF, None)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)  # a query keeps the settings it was started with
    try:
        return (
            first.writeStream.format("parquet")
            .option("path", dest)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_CONF)
        else:
            spark.conf.set(PROVIDER_CONF, before)


def remembered(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys that the state at ``checkpoint`` holds now, with the time (epoch ms) until which they count."""
    state = spark.read.format("statestore").option("stateVarName", "seen").load(checkpoint)
    return state.select("key.*", F.col("value.until").alias("until"))
