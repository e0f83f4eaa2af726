"""Archiving of topics, and a continuous clean feed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feira import schemas

TRIGGER_SECONDS = 30
ARCHIVE_DATE = "ingestion_date"


FILES_PER_BATCH = 1_000
OFFSETS_PER_BATCH = 10_000_000


def topic_stream(
    spark: SparkSession, topic: str, bootstrap_servers: str, offsets_per_batch: int = OFFSETS_PER_BATCH
) -> DataFrame:
    """A broker topic from its earliest offset (needs the Kafka connector on the class path).

    A backlog is read in batches of at most ``offsets_per_batch`` messages; all of it is read.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", offsets_per_batch)
        .load()
    )


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.TOPIC_SCHEMA,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Parquet files as a stream, for topics that are landed as files; ``path`` is a folder of them or a single file.

    A backlog is read in batches of at most ``files_per_batch`` files; all of it is read. A path where nothing is
    raises an error instead of giving an empty stream.
    """
    path = path.rstrip("/")
    # The stream reader refuses the plain path of a single file, but takes a pattern that matches it or a folder.
    pattern = f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    if not found:
        raise FileNotFoundError(f"nothing to stream at {path}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(pattern)


def envelope(stream: DataFrame) -> DataFrame:
    """Topic columns as the archive keeps them, with the time of ingestion."""
    return stream.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias(schemas.INGESTED_AT),
    )


def start_append(
    stream: DataFrame, path: str, checkpoint: str, catch_up: bool = False, partition_by: str | None = None
) -> StreamingQuery:
    """Append a stream to Parquet, exactly once per checkpoint.

    ``catch_up`` handles what is there and ends by itself; otherwise a batch starts every 30 seconds.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if catch_up:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{TRIGGER_SECONDS} seconds").start()


def archive_path(base: str, topic: str) -> str:
    return f"{base}/stream_archive/{topic}"


def archive_topics(
    streams: Mapping[str, DataFrame], base: str, catch_up: bool = False
) -> dict[str, StreamingQuery]:
    """One independent archive query per topic, its files in a folder per day of ingestion (``ARCHIVE_DATE``)."""
    return {
        topic: start_append(
            envelope(stream).withColumn(ARCHIVE_DATE, F.to_date(schemas.INGESTED_AT)),
            archive_path(base, topic),
            f"{base}/stream_archive/_checkpoints/{topic}",
            catch_up,
            ARCHIVE_DATE,
        )
        for topic, stream in streams.items()
    }


def wait_all(queries: Mapping[str, StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until every query has ended; the failure of any is raised as soon as it shows, after the others have been
    stopped. Queries that run for ever do not hide it: all of them are looked at in turn."""
    running = list(queries.values())
    try:
        while running:
            # Ends at once for a query that is over, and raises what it failed with.
            running = [q for q in running if not q.awaitTermination(poll_seconds / len(running))]
    except Exception:
        for query in queries.values():
            query.stop()
        raise


def deduplicate_replays(
    stream: DataFrame, key: str, max_replay_delay: str = "7 days", arrival_col: str | None = None
) -> DataFrame:
    """Drop repeats of a key that arrive within ``max_replay_delay`` of its first arrival; a key is never lost.

    Keys are remembered by the time they arrive (``arrival_col``, or the time of their batch), so however old an event
    is, it is not late. What is replayed after the delay (the topic's retention) passes again; the merge of the clean
    layer, which keeps one row per key, collapses that.
    """
    arrived = arrival_col or "__arrived"
    timed = stream if arrival_col else stream.withColumn(arrived, F.current_timestamp())
    unique = timed.withWatermark(arrived, max_replay_delay).dropDuplicatesWithinWatermark([key])
    return unique if arrival_col else unique.drop(arrived)
