"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the operators rely on. AQE turns a shuffle join into a broadcast only after it has
# measured the side, splits hot join partitions, and sizes the partitions of a rebalanced write.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def get_session(app: str = "starmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; cluster sizing stays with whoever submits the job."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only by a local session that has none configured.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    local = tempfile.mkdtemp(prefix="starmart-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that this library made."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_dropping: dict[object, tuple[int, str]] = {}
_dropping_lock = Lock()


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes and actions begun inside delete their shuffle files when they end.

    Otherwise these stay until the driver happens to collect its garbage, so that a load of many steps holds
    the shuffles of all of them. A frame that is run twice inside shuffles twice, as two frames would. May be
    nested and used by several threads: the session's own setting comes back with the last.
    """
    session = spark._jsparkSession.sessionUUID()
    with _dropping_lock:
        users, before = _dropping.get(session, (0, spark.conf.get(CLEANUP_CONF, "false")))
        _dropping[session] = users + 1, before
        spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            users, before = _dropping.pop(session)
            if users > 1:
                _dropping[session] = users - 1, before
            else:
                spark.conf.set(CLEANUP_CONF, before)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) below the shared folder."""
    return f"{checkpoint_base(spark)}/{label}-{uuid.uuid4().hex}"
