"""Staging with a ledger: every raw file is loaded once, however often its folder is listed.

The ledger holds one row per file and batch: the file's name, length and time as listed, and the
batch that staged it. A listing is anti-joined with it; what is left, up to ``max_files``, is the next
batch. Rows go to a folder of the batch, named in them with their file. The batch counts from the
moment its ledger folder is complete: a run that dies earlier leaves a folder that no reader sees
and that the next run replaces.

A file that was replaced (same name, another length or time) is staged again, and ``read_staged``
leaves out the rows of its earlier version. One writer at a time.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import files
from starmart.schemas import TableSpec
from starmart.sinks.parquet import write_parquet
from starmart.sources.json_files import CORRUPT_COLUMN, date_prefix, good_rows, json_options

FILE_COLUMN, BATCH_COLUMN = "staged_file", "staged_batch"
# Names of the files of a batch go through the driver, as they do for any reader.
MAX_FILES = 10_000
LEDGER = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.LongType()),
        T.StructField(BATCH_COLUMN, T.IntegerType()),
    ]
)


class Staged(NamedTuple):
    """What one call has staged."""

    batches: int
    files: int
    rows: int


def list_files(spark: SparkSession, src: str, pattern: str = "*.json") -> DataFrame:
    """``path``, ``file``, ``length`` and ``modified`` of the files below a folder; none is opened.

    ``path`` is for readers, ``file`` is the name that Spark gives the rows of a file.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return found.load(src).select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
    )


def committed_batches(spark: SparkSession, ledger: str) -> int:
    """The number of the last complete batch; 0 if there is none."""
    numbers = [int(n.split("=")[1]) for n in files.names(spark, ledger) if n.startswith(f"{BATCH_COLUMN}=")]
    complete = [n for n in numbers if files.exists(spark, f"{ledger}/{BATCH_COLUMN}={n}/_SUCCESS")]
    return max(complete, default=0)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All files of complete batches."""
    last = committed_batches(spark, ledger)
    if not last:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger).filter(F.col(BATCH_COLUMN) <= last)


def new_files(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files that the ledger does not hold with this length and time, as the latest of their name."""
    latest = known.groupBy("file").agg(F.max_by(F.struct("length", "modified"), BATCH_COLUMN).alias("at"))
    return listing.join(latest.select("file", "at.*"), ["file", "length", "modified"], "left_anti")


def _stage_batch(
    spark: SparkSession, batch: list, number: int, dest: str, ledger: str, spec: TableSpec, corrupt: str
) -> int:
    schema, options = json_options(spec, corrupt)
    rows = spark.read.schema(schema).options(**options).json([f["path"] for f in batch])
    rows = rows.select("*", F.col("_metadata.file_path").alias(FILE_COLUMN))
    staged = write_parquet(rows, f"{dest}/{BATCH_COLUMN}={number}", mode="overwrite")
    entries = spark.createDataFrame([(f["file"], f["length"], f["modified"]) for f in batch], LEDGER[:3])
    # The files' names fit one file: they have just been on the driver.
    entries.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/{BATCH_COLUMN}={number}")
    return staged


def stage_new_files(
    spark: SparkSession,
    src: str,
    dest: str,
    ledger: str,
    spec: TableSpec,
    day: date | None = None,
    day_style: str = "plain",
    corrupt: str = "keep",
    max_files: int = MAX_FILES,
) -> Staged:
    """Stage the JSON files below ``src`` that have not been staged yet, oldest first.

    ``max_files`` bounds one batch, not the call: batches follow until no new file is left. Running it
    again without new files does nothing. ``day`` and ``corrupt`` as for ``stage_json``.
    """
    listing = list_files(spark, date_prefix(src, day, day_style))
    done = Staged(0, 0, 0)
    while True:
        fresh = new_files(listing, read_ledger(spark, ledger))
        batch = fresh.orderBy("modified", "file").limit(max_files).collect()
        if not batch:
            return done
        number = committed_batches(spark, ledger) + 1
        rows = _stage_batch(spark, batch, number, dest, ledger, spec, corrupt)
        done = Staged(done.batches + 1, done.files + len(batch), done.rows + rows)


def read_staged(
    spark: SparkSession, dest: str, ledger: str, spec: TableSpec, after: int = 0, corrupt: str = "keep"
) -> DataFrame:
    """Rows of complete batches, without those of replaced file versions and lines that did not parse.

    ``after`` gives the rows of later batches only: what is new since a load that noted the batch. Of the
    older folders nothing is read then.
    """
    schema, _ = json_options(spec, corrupt)
    for name, kind in ((FILE_COLUMN, T.StringType()), (BATCH_COLUMN, T.IntegerType())):
        schema = T.StructType([*schema, T.StructField(name, kind)])
    known = read_ledger(spark, ledger)
    last = committed_batches(spark, ledger)
    if last <= after:
        return spark.createDataFrame([], T.StructType([f for f in schema if f.name in spec.columns]))
    rows = spark.read.schema(schema).parquet(dest)
    rows = rows.filter((F.col(BATCH_COLUMN) <= last) & (F.col(BATCH_COLUMN) > after))
    replaced = known.groupBy("file").agg(F.max(BATCH_COLUMN).alias("latest"), F.count(F.lit(1)).alias("n"))
    replaced = replaced.filter("n > 1").select(F.col("file").alias(FILE_COLUMN), "latest")
    if not replaced.isEmpty():
        # Few files are ever replaced; Spark broadcasts their names once it has measured them.
        rows = rows.join(replaced, FILE_COLUMN, "left").filter(
            F.col("latest").isNull() | (F.col(BATCH_COLUMN) == F.col("latest"))
        )
    kept = [*spec.columns, *([CORRUPT_COLUMN] if corrupt == "keep" else [])]
    return good_rows(rows.select(*kept))
