"""DataFrame-to-DataFrame operators. All are lazy unless their docstring says otherwise."""

from starmart.operators.clean import conform, impute_missing, require_finite, require_present
from starmart.operators.dedup import (
    dedup_by_key,
    distinct_rows,
    latest_by_time_join,
    latest_per_key,
    merge_latest,
)
from starmart.operators.history import as_of, intervals, sightings
from starmart.operators.id_ranges import add_reserved_id, reserve
from starmart.operators.identity import add_id
from starmart.operators.joins import anti_new, enrich
from starmart.operators.near_match import enrich_near
from starmart.operators.quality import (
    QualityError,
    TableCheck,
    check_keys,
    check_min_rows,
    check_not_null,
    check_unique,
    preview,
    row_counts,
)
from starmart.operators.skew import hot_keys

__all__ = [
    "QualityError",
    "TableCheck",
    "add_id",
    "add_reserved_id",
    "anti_new",
    "as_of",
    "check_keys",
    "check_min_rows",
    "check_not_null",
    "check_unique",
    "conform",
    "dedup_by_key",
    "distinct_rows",
    "enrich",
    "enrich_near",
    "hot_keys",
    "impute_missing",
    "intervals",
    "latest_by_time_join",
    "latest_per_key",
    "merge_latest",
    "preview",
    "require_finite",
    "require_present",
    "reserve",
    "row_counts",
    "sightings",
]
