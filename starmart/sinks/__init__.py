"""Writing tables: plain Parquet folders and catalog tables."""

from starmart.sinks.audit import Audit, has_rows
from starmart.sinks.buckets import append_bucketed, new_for_bucketed
from starmart.sinks.days import Replaced, read_days, replace_days, replay_days
from starmart.sinks.history import read_history, update_history
from starmart.sinks.key_filter import add_keys, filtered_anti_new, read_sketch
from starmart.sinks.loads import LoadResult, load_fact, load_new, read_target
from starmart.sinks.parquet import append, write_parquet
from starmart.sinks.parts import ensure_parted, read_parted, upsert_parts
from starmart.sinks.tables import (
    drop_table,
    ensure_table,
    load_dimension,
    name_folder,
    publish,
    table_location,
    upsert_dimension,
)

__all__ = [
    "Audit",
    "LoadResult",
    "Replaced",
    "add_keys",
    "append",
    "append_bucketed",
    "drop_table",
    "ensure_parted",
    "ensure_table",
    "filtered_anti_new",
    "has_rows",
    "load_dimension",
    "load_fact",
    "load_new",
    "name_folder",
    "new_for_bucketed",
    "publish",
    "read_days",
    "read_history",
    "read_parted",
    "read_sketch",
    "read_target",
    "replace_days",
    "replay_days",
    "table_location",
    "update_history",
    "upsert_dimension",
    "upsert_parts",
    "write_parquet",
]
