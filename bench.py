"""Time the headline queries at one scale and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores. Each
query runs once to warm up and then three times; the median counts. Results go to Spark's noop
sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmart.plans.queries import QUERIES
from starmart.session import get_session

HEADLINE = (
    "songplays_fact",
    "songplays_rounded",
    "songplays_bulk",
    "songplays_by_artist_salted",
    "songs_dim",
    "artists_dim",
    "artists_distinct",
    "users_latest",
    "users_distinct",
    "users_by_time_join",
    "latest_order_tiebreak",
    "user_max_ts",
    "time_dim_iso",
    "time_dim_log",
    "time_dim_seconds",
    "new_by_key",
    "new_by_key_nulls",
    "new_by_composed_key_24h",
    "new_by_typed_key",
    "epoch_seconds",
    "conform_users",
    "impute_partition_cols",
    "sequence_ids",
    "pk_violations",
    "null_counts",
    "row_counts",
    "load_twice_counts",
    "load_fact_twice",
    "upsert_users",
    "stage_roundtrip",
    "stage_day",
    "partition_read",
    "stream_fact_equals_batch",
    "load_fact_pruned",
    "stream_users",
    "warehouse_load",
    "lake_load",
    "songplays_tolerant",
    "new_by_filter",
    "user_level_history",
    "level_at_event",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total of the median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
