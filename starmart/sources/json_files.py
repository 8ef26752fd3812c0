"""JSON-lines sources with a fixed schema: no inference pass over the files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import TableSpec
from starmart.sinks.parquet import write_parquet

CORRUPT_COLUMN = "_corrupt_record"
CORRUPT_MODES = ("keep", "drop", "fail")

# The glob depths of the two raw layouts, and the date folders of a daily layout.
SONG_FILES = "song_data/*/*/*/*.json"
LOG_FILES = "log-data/*/*/*.json"
DAY_FOLDERS = {"plain": "{0:%Y}/{0:%m}/{0:%d}/", "hive": "year={0.year}/month={0.month}/day={0.day}/"}


def date_prefix(base: str, day: date | None, style: str = "plain") -> str:
    """``base`` extended by the folder of one day; ``base`` itself without a day.

    ``style="hive"`` is the ``year=/month=/day=`` naming that a partitioned Spark write produces.
    """
    if style not in DAY_FOLDERS:
        raise ValueError(f"style is one of {tuple(DAY_FOLDERS)}, not {style!r}")
    return base if day is None else base.rstrip("/") + "/" + DAY_FOLDERS[style].format(day)


def json_options(
    spec: TableSpec | T.StructType, corrupt: str
) -> tuple[T.StructType, dict[str, str]]:
    """Schema and reader options for JSON lines, of files or of a stream."""
    if corrupt not in CORRUPT_MODES:
        raise ValueError(f"corrupt is one of {CORRUPT_MODES}, not {corrupt!r}")
    schema = spec.schema if isinstance(spec, TableSpec) else spec
    # File columns may always be absent; NOT NULL is checked on the target.
    fields = [T.StructField(f.name, f.dataType, True) for f in schema]
    if corrupt != "keep":
        return T.StructType(fields), {"mode": "DROPMALFORMED" if corrupt == "drop" else "FAILFAST"}
    fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    return T.StructType(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def read_json(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec | T.StructType,
    corrupt: str = "keep",
    recursive: bool | None = None,
) -> DataFrame:
    """JSON lines under a folder or glob, with the columns of ``spec``; fields match by exact name.

    Bad lines: ``keep`` adds ``_corrupt_record`` holding their text, ``drop`` removes them, ``fail``
    stops the job. Spark parses only the columns a query uses, so whether a line counts as bad can
    differ between queries; ``stage_json`` parses all of them once and settles it. A folder without
    a glob is read with everything below it, as a prefix would be.
    """
    schema, options = json_options(spec, corrupt)
    paths = [path] if isinstance(path, str) else path
    if recursive is None:
        recursive = not any("*" in p for p in paths)
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower()).options(**options)
    return reader.schema(schema).json(paths)


def stage_json(
    spark: SparkSession,
    src: str,
    dest: str,
    spec: TableSpec,
    mode: str = "overwrite",
    day: date | None = None,
    day_style: str = "plain",
    corrupt: str = "keep",
    compact: bool = False,
) -> int:
    """Copy raw JSON into a Parquet staging folder in one pass; returns the number of rows.

    ``overwrite`` replaces what was staged, ``append`` adds to it. ``day`` loads that day's folder
    only. The ``_corrupt_record`` column is kept in the staging folder under ``corrupt="keep"``.
    ``compact`` shuffles the rows into files of even size, for sources of many small files.
    """
    raw = read_json(spark, date_prefix(src, day, day_style), spec, corrupt)
    return write_parquet(raw.hint("rebalance") if compact else raw, dest, mode=mode)


def good_rows(staged: DataFrame) -> DataFrame:
    """Staged rows that parsed, without the ``_corrupt_record`` column."""
    if CORRUPT_COLUMN not in staged.columns:
        return staged
    return staged.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
