"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_scope = threading.local()


def build_session(name: str = "streamscreen", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="streamscreen-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str = "stage", *, outlives: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on executor-held blocks or on recomputing its input. Within ``temporary_tables`` the
    table goes with the block, unless it ``outlives`` it.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    written = getattr(_scope, "paths", None)
    if written is not None and not outlives:
        written.append(path)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.durable_path = path
    return kept


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the tables that ``durable`` writes within the block (in this thread)."""
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        for path in _scope.paths:
            _delete(spark, path)
        _scope.paths = outer


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What runs within the block sends Python workers at most ``rows`` rows at a time.

    A batch is held by the JVM and by the worker at once, outside the heap, and Spark's 10 000 rows of whole texts are many. A smaller
    setting of the session stays.
    """
    own = int(spark.conf.get(ARROW_ROWS))
    if 0 < own <= rows:
        yield
        return
    spark.conf.set(ARROW_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, own)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete the table that ``durable`` made ``df`` of; to be called once nothing reads it any more.

    Other DataFrames are left alone.
    """
    path = getattr(df, "durable_path", None)
    if path is not None:
        _delete(df.sparkSession, path)
