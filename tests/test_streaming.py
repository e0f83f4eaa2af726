import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feira import schemas
from feira.operators.clean import merge_batch_and_stream
from feira.plans import registry
from feira.streaming import archive

START = dt.datetime(2018, 1, 1, tzinfo=dt.timezone.utc)


def land(spark, path, rows):
    """rows: (key, value, topic, partition, offset, minute)"""
    data = [
        (bytearray(k.encode()), bytearray(v.encode()), t, p, o, START + dt.timedelta(minutes=m))
        for k, v, t, p, o, m in rows
    ]
    spark.createDataFrame(data, schemas.TOPIC_SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def order(order_id, status):
    return json.dumps({**dict.fromkeys(schemas.RAW_SCHEMAS["orders"].names), "order_id": order_id, "order_status": status})


def run(spark, streams, base):
    archive.wait_all(archive.archive_topics(streams, base, catch_up=True))


def test_topics_are_archived_once_and_resumed(spark, tmp_path):
    topics = (schemas.ORDERS_TOPIC, schemas.LOGISTICS_TOPIC)
    for i, topic in enumerate(topics):
        land(spark, tmp_path / topic, [("c1", order("o1", "created"), topic, 0, 10 + i, 0)])
    base = str(tmp_path / "lake")

    def streams():
        return {t: archive.file_stream(spark, str(tmp_path / t)) for t in topics}

    def archived(topic):
        return spark.read.parquet(archive.archive_path(base, topic))

    run(spark, streams(), base)
    assert [archived(t).count() for t in topics] == [1, 1]
    assert archived(topics[0]).columns == [*schemas.ARCHIVE_SCHEMA.names, archive.ARCHIVE_DATE]
    row = archived(topics[0]).first()
    assert (row["kafka_key"], row["kafka_topic"], row["kafka_offset"]) == ("c1", topics[0], 10)
    assert row[schemas.INGESTED_AT] is not None
    run(spark, streams(), base)
    assert [archived(t).count() for t in topics] == [1, 1]
    land(spark, tmp_path / topics[0], [("c1", order("o1", "canceled"), topics[0], 0, 11, 1)])
    run(spark, streams(), base)
    assert [archived(t).count() for t in topics] == [2, 1]
    empty = spark.createDataFrame([], schemas.RAW_SCHEMAS["orders"])
    merged = merge_batch_and_stream(empty, archived(topics[0]), schemas.RAW_SCHEMAS["orders"], "order_id")
    assert [r["order_status"] for r in merged.collect()] == ["canceled"]


def test_replays_are_dropped_across_runs(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def catch_up():
        events = archive.file_stream(spark, source).selectExpr("cast(key as string) id", "timestamp")
        clean = archive.deduplicate_replays(events, "id", "1 hour")
        archive.start_append(clean, out, checkpoint, catch_up=True).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    land(spark, source, [("a", "", "t", 0, 1, 0), ("b", "", "t", 0, 2, 1), ("a", "", "t", 0, 3, 2)])
    assert catch_up() == ["a", "b"]
    land(spark, source, [("a", "", "t", 0, 4, 5), ("c", "", "t", 0, 5, 6)])
    assert catch_up() == ["a", "b", "c"]


def test_old_events_that_arrive_late_are_kept(spark, tmp_path):
    """Newer files land before older ones, then one is replayed: every key once."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    day = 24 * 60
    for days in (90, 30, 60, 0, 30):
        land(spark, source, [(f"{days}-{i}", "", "t", 0, days * 10 + i, days * day) for i in range(5)])
    events = archive.file_stream(spark, source, files_per_batch=1).selectExpr("cast(key as string) id", "timestamp")
    clean = archive.deduplicate_replays(events, "id")
    query = archive.start_append(clean, out, checkpoint, catch_up=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 5
    rows = [r["id"] for r in spark.read.parquet(out).collect()]
    assert sorted(rows) == sorted(f"{d}-{i}" for d in (0, 30, 60, 90) for i in range(5))


def test_file_stream_takes_files_and_folders_and_refuses_nothing(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for number, path in enumerate((f"{sf_dir}/events.parquet", str(tmp_path / "events.parquet"))):
        stream = archive.file_stream(spark, path, events.schema)
        out, checkpoint = str(tmp_path / f"o{number}"), str(tmp_path / f"c{number}")
        archive.start_append(stream, out, checkpoint, catch_up=True).awaitTermination()
        assert spark.read.parquet(out).count() == events.count()
    with pytest.raises(FileNotFoundError):
        archive.file_stream(spark, str(tmp_path / "missing"))


@pytest.mark.parametrize("name", ["archive_stream", "stream_dedup"])
def test_stream_queries_on_a_folder_table(spark, sf_dir, tmp_path, name):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    found = sorted(map(tuple, registry.QUERIES[name](spark, str(tmp_path)).collect()))
    assert len(found) == events.count() and found == sorted(map(tuple, registry.QUERIES[name](spark, sf_dir).collect()))


def test_hot_second_of_the_replays_is_not_landed_by_one_task(spark, sf_dir, tmp_path, monkeypatch):
    """Events without a time and of one second stay in their partitions, and parts are still streamed newest first."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, None).when(F.col("event_id") % 3 == 1, F.lit(START)).otherwise(F.col("ts"))
    events.withColumn("ts", hot.cast(events.schema["ts"].dataType)).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(registry, "scratch_path", lambda _, name: str(tmp_path / f"scratch-{name}"))
    found = [r.offset for r in registry.stream_dedup(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(r.event_id for r in events.collect())
    landed = spark.read.parquet(str(tmp_path / "scratch-events"))
    sizes = [r["count"] for r in landed.filter("ts is null").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 3 and max(sizes) < 0.5 * sum(sizes)
    # The part without a time is the last one, read by the last run.
    nulls = {r[0].rsplit("/", 1)[1] for r in landed.filter("ts is null").select(F.input_file_name()).distinct().collect()}
    logs = sorted((tmp_path / "scratch-dedup-checkpoint" / "sources" / "0").glob("[0-9]*"), key=lambda p: int(p.name))
    read = [{n for n in nulls if n in p.read_text()} for p in logs]
    assert len(read) > 1 and read[-1] == nulls and not any(read[:-1])


def test_failure_of_one_query_stops_the_others():
    class Query:
        def __init__(self, error=None):
            self.error, self.stopped = error, False

        def awaitTermination(self, timeout=None):
            if self.error:
                raise self.error
            return True

        def stop(self):
            self.stopped = True

    queries = {"a": Query(RuntimeError("x")), "b": Query()}
    with pytest.raises(RuntimeError):
        archive.wait_all(queries)
    assert queries["b"].stopped


def test_thirty_second_trigger(spark, tmp_path):
    land(spark, tmp_path / "in", [("a", "", "t", 0, 1, 0)])
    query = archive.start_append(
        archive.envelope(archive.file_stream(spark, str(tmp_path / "in"))), str(tmp_path / "o"), str(tmp_path / "c")
    )
    try:
        query.processAllAvailable()
        assert spark.read.parquet(str(tmp_path / "o")).count() == 1
    finally:
        query.stop()
