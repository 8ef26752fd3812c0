"""Structured Streaming forms of the loads: each run takes only the files that are new."""

from starmart.streaming.keyed import remembered, stream_dedup_keyed
from starmart.streaming.loads import (
    read_json_stream,
    read_stream_fact,
    stream_dedup,
    stream_dedup_within,
    stream_fact,
    stream_stage,
    stream_upsert_latest,
)

__all__ = [
    "read_json_stream",
    "read_stream_fact",
    "remembered",
    "stream_dedup",
    "stream_dedup_keyed",
    "stream_dedup_within",
    "stream_fact",
    "stream_stage",
    "stream_upsert_latest",
]
