"""Reading and staging raw JSON."""

from starmart.sources.json_files import CORRUPT_COLUMN, date_prefix, read_json, stage_json
from starmart.sources.ledger import Staged, list_files, read_ledger, read_staged, stage_new_files

__all__ = [
    "CORRUPT_COLUMN",
    "Staged",
    "date_prefix",
    "list_files",
    "read_json",
    "read_ledger",
    "read_staged",
    "stage_json",
    "stage_new_files",
]
