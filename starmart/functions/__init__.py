"""Column functions: everything here maps columns to a column and stays in generated code."""

from starmart.functions.missing import is_missing, is_present
from starmart.functions.textkeys import compose_key, hash_key, time_key
from starmart.functions.timeparts import (
    CALENDAR_PARTS,
    calendar_part,
    calendar_parts,
    epoch_ms_to_ts,
    ts_to_epoch_ms,
    ts_to_epoch_seconds,
)

__all__ = [
    "CALENDAR_PARTS",
    "calendar_part",
    "calendar_parts",
    "compose_key",
    "epoch_ms_to_ts",
    "hash_key",
    "is_missing",
    "is_present",
    "time_key",
    "ts_to_epoch_ms",
    "ts_to_epoch_seconds",
]
