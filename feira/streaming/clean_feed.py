"""A clean table kept by a stream: typed, one row per key, the latest message winning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feira.functions.casts import apply_table_casts
from feira.operators.clean import newest_first, parse_payload
from feira.operators.groups import first_per_key
from feira.streaming.archive import TRIGGER_SECONDS

_BATCH, _BASE = "batch", "base"


def latest_messages(archived: DataFrame, payload: T.StructType, table: str, key: str) -> DataFrame:
    """Typed payloads of archived messages, the latest per key, with their place in the topic. A message that is no
    JSON or has no key belongs to no row and is left out."""
    parsed = parse_payload(archived, payload).filter(F.col(key).isNotNull())
    return first_per_key(apply_table_casts(parsed, table), [key], newest_first())


def start_clean_feed(
    stream: DataFrame, path: str, checkpoint: str, payload: T.StructType, table: str, key: str, catch_up: bool = False
) -> StreamingQuery:
    """Keep a clean table from a stream of archived messages (``archive.envelope``).

    Every batch writes the latest message per key into a folder named by its number, replacing what an earlier attempt
    at the same batch has left: a batch that is delivered twice, or half written before a crash, changes nothing. What
    batches disagree on, late and repeated messages included, is settled by the place in the topic when the table is
    read, so batches may come in any order and a replay collapses however old it is.
    """

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, path, payload, table, key)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if catch_up:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{TRIGGER_SECONDS} seconds").start()


def write_batch(batch: DataFrame, number: int, path: str, payload: T.StructType, table: str, key: str) -> None:
    latest_messages(batch, payload, table, key).write.mode("overwrite").parquet(f"{path}/{_BATCH}={number}")


def _folders(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Numbers of the folders that were written to their end."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {_BATCH: [], _BASE: []}
    for status in files.listStatus(root) if files.exists(root) else []:
        kind, _, number = status.getPath().getName().partition("=")
        if kind in found and files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[kind].append(int(number))
    return found


def _parts(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """The folders that make up the table, and the number of its latest batch."""
    found = _folders(spark, path)
    base = max(found[_BASE], default=-1)
    newer = [n for n in sorted(found[_BATCH]) if n > base]
    folders = [f"{path}/{_BASE}={base}"] if base >= 0 else []
    return folders + [f"{path}/{_BATCH}={n}" for n in newer], max([base, *newer])


def _with_places(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    folders, _ = _parts(spark, path)
    if not folders:
        return None
    return first_per_key(spark.read.parquet(*folders), [key], newest_first())


def read_clean_feed(spark: SparkSession, path: str, key: str, head: DataFrame | None = None) -> DataFrame:
    """The table as of the last whole batch: one row per key. ``head`` is a clean table from before the stream; the
    stream wins over it."""
    rows = _with_places(spark, path, key)
    if rows is None:
        if head is None:
            raise FileNotFoundError(f"no batch has been written to {path}")
        return head
    streamed = rows.drop("kafka_partition", "kafka_offset")
    if head is None:
        return streamed
    return head.join(streamed.select(key), key, "left_anti").unionByName(streamed)


def fold(spark: SparkSession, path: str, key: str) -> int:
    """Merge all whole batches into one base folder, so that reading does not slow down with their number.

    Returns the number of the last batch in it. The folders it replaces are not read any more; delete them once no
    reader holds an older view. A fold that is broken off leaves the table as it was.
    """
    rows = _with_places(spark, path, key)
    if rows is None:
        return -1
    last = _parts(spark, path)[1]
    rows.write.mode("overwrite").parquet(f"{path}/{_BASE}={last}")
    return last
