"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RUNTIME_SETTINGS = {
    # All smart date keys and timestamps are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time even when that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A page so deep that its rows would not fit a task's heap of best rows is sorted through files instead.
    "spark.sql.execution.topKSortFallbackThreshold": "1000000",
    # Streaming state lives on local disk with checkpoints, not in executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_dirs: dict[str, str] = {}
_scope = threading.local()
# Copies made outside any scope, by application.
_unowned: dict[str, list[str]] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to an existing session."""
    for key, value in _RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets a folder of
    its own; a cluster without it is refused, because a machine-local folder dies with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app in _local_dirs:
        return _local_dirs[app]
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder before running on {master}")
    own = tempfile.mkdtemp(prefix="feira-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    _local_dirs[app] = own
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/feira/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared scratch area and return a scan of the written files.

    Unlike a cache this survives lost executors, gives later column pruning and pushdown a real scan, and tells
    the planner the true size, so that small results are broadcast by Spark's own threshold and large ones not.
    Tables of texts take half the space with ``compression="zstd"``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    paths = getattr(_scope, "paths", None)
    (_unowned.setdefault(spark.sparkContext.applicationId, []) if paths is None else paths).append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete what this application has materialized outside any ``scratch_scope``; returns the number of copies.

    To be called when the results that were built from them have been written, at the latest before the session stops.
    """
    paths = _unowned.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what this thread materializes inside the block at its end, when the result has been written."""
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        inner, _scope.paths = _scope.paths, outer
        for path in inner:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
