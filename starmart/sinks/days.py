"""Replacing days: a load of some days may be run again, and only their folders change."""

from __future__ import annotations

from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import files
from starmart.schemas import TableSpec
from starmart.sinks.parquet import write_parquet
from starmart.sources.json_files import date_prefix, good_rows, json_options

DAY_PARTS = ("year", "month", "day")


class Replaced(NamedTuple):
    """Rows written, and days of the range that have none now but had some before."""

    rows: int
    emptied: int


def days_between(first: date, last: date) -> list[date]:
    if last < first:
        raise ValueError(f"{last} is before {first}")
    return [first + timedelta(n) for n in range((last - first).days + 1)]


def day_of(*parts: str):
    """The date of year, month and day columns; null if they are none."""
    return F.try_make_timestamp_ntz(*[F.col(c) for c in parts], F.lit(0), F.lit(0), F.lit(0)).cast("date")


def replace_days(
    df: DataFrame, path: str, first: date, last: date, sort_by: tuple[str, ...] = ()
) -> Replaced:
    """Make ``df`` the content of the folders ``year=/month=/day=`` of ``first`` to ``last`` below ``path``.

    ``df`` has integer columns ``year``, ``month`` and ``day``; its rows of other days are not written. Spark
    writes aside and exchanges the folders that got rows when the job commits, so a failed run changes
    nothing and a repeated one gives the same. Folders of the range without rows are removed after that;
    all others keep their files.
    """
    spark = df.sparkSession
    folders = {d: date_prefix(path, d, "hive").rstrip("/") for d in days_between(first, last)}
    before = {d: files.names(spark, folder) for d, folder in folders.items()}
    day = day_of(*DAY_PARTS)
    rows = df.filter(day.between(F.lit(first), F.lit(last)))
    written = write_parquet(rows, path, DAY_PARTS, "overwrite", sort_by, dynamic=True)
    emptied = [d for d, old in before.items() if old and files.names(spark, folders[d]) == old]
    for d in emptied:
        files.remove(spark, folders[d])
    return Replaced(written, len(emptied))


def read_days(
    spark: SparkSession, src: str, first: date, last: date, spec: TableSpec, style: str = "plain", corrupt: str = "keep"
) -> DataFrame:
    """The JSON rows of a range of daily folders with ``year``, ``month`` and ``day`` of their folder; days
    without a folder are passed over."""
    schema, options = json_options(spec, corrupt)
    paths = [p for d in days_between(first, last) if files.exists(spark, p := date_prefix(src, d, style))]
    reader = spark.read.schema(schema).options(**options).option("recursiveFileLookup", "true")
    rows = reader.json(paths) if paths else spark.createDataFrame([], schema)
    # A folder is one of the days asked for, so its date is the last of that form in the file's name.
    place = F.col("_metadata.file_path") if paths else F.lit("")
    parts = r"^.*/(?:year=)?(\d{4})/(?:month=)?(\d{1,2})/(?:day=)?(\d{1,2})/"
    numbers = [F.regexp_extract(place, parts, n + 1).try_cast("int").alias(c) for n, c in enumerate(DAY_PARTS)]
    return good_rows(rows.select("*", *numbers))


def replay_days(
    spark: SparkSession, src: str, dest: str, first: date, last: date, spec: TableSpec, style: str = "plain",
    corrupt: str = "keep", sort_by: tuple[str, ...] = (),
) -> Replaced:
    """Stage a range of days again: their folders below ``dest`` become what their raw folders hold now."""
    return replace_days(read_days(spark, src, first, last, spec, style, corrupt), dest, first, last, sort_by)
