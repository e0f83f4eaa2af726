"""Line breaks in CSV, deep pages, ordered events, the continuous clean feed, failures and crashes of streams."""

import csv
import random
import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira import schemas
from feira.sources import readers
from feira.sources.pages import PageIndex
from feira.streaming import archive, clean_feed, ordered

SHAPE = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "left", "right")])
VALUES = [
    "plain", "a,b", 'say "hi"', "two\nlines", "x\n\n\ny,z", "", None, "\n", "long " * 40 + "\n" + "more " * 60,
    '"', '""', 'end"\n"start', "  pad ", "é\nü", "null",
]


def _write(path, rows, mark="", end="\n"):
    def shown(v, rng=random.Random(1)):
        if v is None:
            return ""
        quoted = any(x in v for x in ',"\n') or not v or rng.random() < 0.2
        return '"' + v.replace('"', '""') + '"' if quoted else v

    text = mark + "id,left,right" + end + "".join(",".join(map(shown, r)) + end for r in rows)
    path.write_text(text, encoding="utf-8", newline="")


@pytest.fixture
def split_size(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def set_(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "1")

    yield set_
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", ["128m", "6000", "300"])
def test_quoted_line_breaks_over_many_tasks(spark, tmp_path, split_size, size):
    rng = random.Random(2)
    rows = [(str(i), rng.choice(VALUES), rng.choice(VALUES)) for i in range(1200)]
    _write(tmp_path / "one.csv", rows[:700])
    _write(tmp_path / "two.csv", rows[700:], mark="﻿")
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    whole = spark.read.schema(SHAPE).options(**options).csv(str(tmp_path))
    split_size(size)
    found = readers.read_csv(spark, str(tmp_path), SHAPE, line_breaks=True)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks >= {"128m": 2, "6000": 6, "300": 100}[size]
    # Rows agree with an independent reader too, where it can tell an empty value from none.
    with open(tmp_path / "one.csv", newline="", encoding="utf-8") as f:
        told = [tuple(r) for r in csv.reader(f)][1:]
    assert sorted(tuple(v or "" for v in r) for r in found.collect() if int(r.id) < 700) == sorted(told)


def test_headers_with_breaks_crlf_blank_lines_and_odd_quotes(spark, tmp_path, split_size):
    split_size("4")
    one = tmp_path / "a.csv"
    one.write_bytes(b'"the\nid","l\n\neft",right\r\n1,"x\ny",z\r\n\r\n2,b,c')
    found = readers.read_csv(spark, str(one), SHAPE, line_breaks=True).orderBy("id").collect()
    assert [tuple(r) for r in found] == [("1", "x\ny", "z"), ("2", "b", "c")]
    (tmp_path / "none.csv").write_text("id,left,right\n")
    assert readers.read_csv(spark, str(tmp_path / "none.csv"), SHAPE, line_breaks=True).count() == 0
    (tmp_path / "bad.csv").write_text('id,left,right\n1,"open,2\n')
    with pytest.raises(ValueError, match="bad.csv"):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), SHAPE, line_breaks=True)


def test_pages_of_any_depth_read_their_slices_only(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("v"))
    # Slices of a size that only large tables have.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    index = PageIndex(df.repartition(6), ["v"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert index.total_rows == 5000 and index.pages(70) == 72 and len(index.slices) > 1
    rows = sorted((r.v, r.k) for r in df.collect())
    for page in (1, 2, 24, 47, 71, 72, 73):
        found = [(r.v, r.k) for r in index.page(page, 70).collect()]
        assert found == rows[(page - 1) * 70 : page * 70]
    plan = plan_of(index.page(72, 70))
    assert "PushedFilters" in plan and "__slice" in plan.split("PushedFilters")[1] and "Offset" not in plan
    assert index.page(72, 70).first().total_rows == 5000
    assert PageIndex(df.limit(0), ["v"]).page(1, 10).count() == 0


class State:
    """A group state as the streaming engine hands it to a function."""

    def __init__(self):
        self.get, self.exists, self.hasTimedOut, self.patience = None, False, False, None

    def update(self, value):
        self.get, self.exists = value, True

    def setTimeoutDuration(self, ms):
        self.patience = ms


def test_events_wait_for_earlier_ones_until_patience_ends():
    work, state = ordered.hold_back("n", 0, 5000), State()

    def told(*numbers):
        pdf = pd.DataFrame({"n": np.array(numbers, np.int64), "v": [f"v{i}" for i in numbers]})
        return [(r.n, r.v, r.place) for out in work(("k",), iter([pdf]), state) for r in out.itertuples()]

    assert told(2, 1) == [] and state.patience == 5000
    assert told(0, 2) == [(0, "v0", 0), (1, "v1", 1), (2, "v2", 2)]
    assert told(1, 0) == []
    assert told(6, 4, 6) == []
    state.hasTimedOut = True
    late = [(r.n, r.place) for out in work(("k",), iter([]), state) for r in out.itertuples()]
    assert late == [(4, 3), (6, 4)] and state.get[0] == 7 and state.get[2] == b""
    state.hasTimedOut = False
    # What comes for a gap that was given up is a replay.
    assert told(3, 5, 7) == [(7, "v7", 5)]


def test_no_cancel_before_its_order(spark, tmp_path):
    events = spark.createDataFrame(
        [(k, n, ["ordered", "paid", "cancelled"][n]) for k in ("x", "y", "z") for n in range(3)], "k string, n long, what string"
    )
    for n in (2, 1, 0):
        events.filter(F.col("n") == n).write.mode("append").parquet(str(tmp_path / "in"))
        stream = archive.file_stream(spark, str(tmp_path / "in"), events.schema)
        released = ordered.in_order(stream, ["k"], "n")
        archive.start_append(released, str(tmp_path / "out"), str(tmp_path / "check"), catch_up=True).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == (9 if n == 0 else 0)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.what, r.place) for r in rows} == {("ordered", 0), ("paid", 1), ("cancelled", 2)}


class Handle:
    """A processor's state as the streaming engine hands it out, with the rows of the largest value that was stored."""

    def __init__(self):
        self.maps, self.values, self.timers, self.largest = {}, {}, set(), 0

    def getValueState(self, name, schema):
        return SimpleNamespace(get=lambda: self.values.get(name), update=lambda v: self.values.update({name: v}))

    def getMapState(self, name, key, value):
        held = self.maps.setdefault(name, {})

        def update(k, v):
            held[k] = v
            if isinstance(v[0], bytes):
                self.largest = max(self.largest, len(ordered._loaded(v[0])))

        return SimpleNamespace(
            getValue=held.get, updateValue=update, removeKey=held.pop, exists=lambda: bool(held), keys=lambda: list(held)
        )

    def listTimers(self):
        return iter(sorted(self.timers))

    def deleteTimer(self, at):
        self.timers.discard(at)

    def registerTimer(self, at):
        self.timers.add(at)


def test_what_waits_is_kept_and_released_by_block(monkeypatch):
    monkeypatch.setattr(ordered, "_GATHERED", 30_000)
    rng = np.random.default_rng(3)
    handle, work = Handle(), ordered.Ordered(["n", "v", "__key"], "n", 0, 5000, block=100)
    work.init(handle)
    now = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 1000)

    def told(numbers):
        numbers = np.asarray(numbers, np.int64)
        pdf = pd.DataFrame({"n": numbers, "v": [f"v{i}" for i in numbers], "__key": "k"})
        batches = (pdf.iloc[i : i + 150] for i in range(0, len(pdf), 150))
        return [[*zip(out["n"], out["v"], out["place"])] for out in work.handleInputRows(("k",), batches, now)]

    # The latest first, shuffled and with repeats; one number stays away.
    for low in (4000, 2000, 1):
        assert told(rng.permutation(np.repeat(np.arange(low, min(low + 2000, 6000)), 2))) == []
    assert handle.largest <= 300 and handle.timers == {6000}
    assert told([7000, 6999]) == []
    out = told([0, 5])
    assert [x for part in out for x in part] == [(i, f"v{i}", i) for i in range(6000)]
    assert max(map(len, out)) <= 100 and told([17, 5999]) == []
    assert {k for k, in handle.maps["waiting"]} == {69, 70} == {k for k, _ in handle.maps["parts"]}
    handle.timers.clear()
    late = [x for part in work.handleExpiredTimer(("k",), now, None) for x in zip(part["n"], part["place"])]
    assert late == [(6999, 6000), (7000, 6001)]
    assert not handle.maps["waiting"] and not handle.maps["parts"]
    assert told([6500, 7001]) == [[(7001, "v7001", 6002)]] and not handle.timers


def test_events_of_many_blocks_and_null_keys_come_in_order(spark, tmp_path):
    numbers = spark.range(300).withColumnRenamed("id", "n")
    odd = F.when(F.col("n") % 7 > 0, F.lit("x")).alias("a b")
    keys = F.explode(F.array(F.lit(None).cast("int"), F.lit(0), F.lit(1))).alias("_k")
    events = numbers.select(keys, "n", odd, F.timestamp_seconds(F.col("n") * 3600).alias("class"))
    for low in (200, 100, 0):
        part = events.filter(f"n >= {low} and n < {low + 100}")
        part.unionByName(part).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = archive.file_stream(spark, str(tmp_path / "in"), events.schema)
        released = ordered.in_order(stream, ["_k"], "n", block=32)
        assert released.columns == [*events.columns, ordered.PLACE]
        archive.start_append(released, str(tmp_path / "out"), str(tmp_path / "check"), catch_up=True).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == (900 if low == 0 else 0)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.filter("place = n").drop("place").exceptAll(events).isEmpty() and found.filter("place = n").count() == 900


def test_a_gap_is_given_up_by_a_running_stream(spark, tmp_path):
    events = spark.createDataFrame([("x", 0, "a"), ("x", 2, "c"), ("x", 40, "d"), ("y", 0, "e")], "k string, n long, what string")
    events.write.parquet(str(tmp_path / "in"))
    stream = archive.file_stream(spark, str(tmp_path / "in"), events.schema)
    released = ordered.in_order(stream, ["k"], "n", patience="1 second", block=16)
    query = released.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query = query.option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="1 second").start()
    try:
        end = time.time() + 90
        while time.time() < end and query.isActive:
            rows = []
            if (tmp_path / "out" / "_spark_metadata").exists():
                rows = spark.read.schema(released.schema).parquet(str(tmp_path / "out")).collect()
            if len(rows) == 4:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert {(r.k, r.what, r.place) for r in rows} == {("x", "a", 0), ("x", "c", 1), ("x", "d", 2), ("y", "e", 0)}


def _messages(spark, rows):
    columns = [f.name for f in schemas.RAW_SCHEMAS["orders"].fields]
    payload = [F.when(F.col("o").isNotNull(), F.col("o")).alias("order_id"), F.col("s").alias("order_status")]
    value = F.when(F.col("o") == "?", F.lit("no json")).otherwise(F.to_json(F.struct(*payload)))
    assert {"order_id", "order_status"} <= set(columns)
    return spark.createDataFrame(rows, "o string, s string, kafka_offset long").select(
        value.alias("kafka_value"), F.lit(0).alias("kafka_partition"), "kafka_offset"
    )


def test_a_batch_that_comes_twice_or_breaks_off_changes_nothing(spark, tmp_path):
    path, payload = str(tmp_path / "feed"), schemas.RAW_SCHEMAS["orders"]

    def write(number, rows):
        clean_feed.write_batch(_messages(spark, rows), number, path, payload, "orders", "order_id")

    def seen():
        return {r.order_id: r.order_status for r in clean_feed.read_clean_feed(spark, path, "order_id").collect()}

    with pytest.raises(FileNotFoundError):
        clean_feed.read_clean_feed(spark, path, "order_id")
    write(0, [("a", "created", 1), ("b", "created", 2), ("a", "shipped", 5), ("?", "x", 6), (None, "y", 7)])
    write(1, [("b", "cancelled", 9), ("c", "created", 3)])
    expected = {"a": "shipped", "b": "cancelled", "c": "created"}
    assert seen() == expected
    write(0, [("a", "created", 1), ("b", "created", 2), ("a", "shipped", 5)])
    assert seen() == expected
    # A batch that broke off has no end mark; its rows are not read, and its next attempt replaces it.
    write(2, [("a", "lost", 99)])
    (tmp_path / "feed" / "batch=2" / "_SUCCESS").unlink()
    assert seen() == expected
    assert clean_feed.fold(spark, path, "order_id") == 1 and seen() == expected
    write(2, [("a", "delivered", 10), ("b", "created", 2)])
    assert seen() == {**expected, "a": "delivered"}
    assert clean_feed.fold(spark, path, "order_id") == 2 and seen() == {**expected, "a": "delivered"}
    head = spark.createDataFrame([("a", "old"), ("d", "old")], "order_id string, order_status string")
    both = clean_feed.read_clean_feed(spark, path, "order_id").select("order_id", "order_status")
    merged = head.join(both.select("order_id"), "order_id", "left_anti").unionByName(both)
    assert {r.order_id for r in merged.collect()} == {"a", "b", "c", "d"}


def test_a_later_query_that_fails_stops_all(spark):
    def fail(batch, number):
        raise RuntimeError("second query fails")

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    first = ticks.writeStream.format("noop").trigger(processingTime="30 seconds").start()
    second = ticks.writeStream.foreachBatch(fail).start()
    with pytest.raises(StreamingQueryException):
        archive.wait_all({"first": first, "second": second}, poll_seconds=0.5)
    assert not first.isActive and not second.isActive


def test_a_run_that_breaks_between_files_and_commit(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def land_and_run(first):
        spark.range(first, first + 10).coalesce(1).write.mode("append").parquet(source)
        stream = archive.file_stream(spark, source, T.StructType([T.StructField("id", T.LongType())]))
        archive.start_append(stream, out, check, catch_up=True).awaitTermination()

    land_and_run(0)
    land_and_run(10)
    before = {p.name for p in (tmp_path / "out").glob("*.parquet")}
    # As if the second run had died when its files stood: neither the sink nor the checkpoint knows of them.
    for path in ((tmp_path / "out" / "_spark_metadata"), (tmp_path / "check" / "commits")):
        last = max(int(p.name) for p in path.iterdir() if p.name.isdigit())
        (path / str(last)).unlink()
        (path / f".{last}.crc").unlink(missing_ok=True)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10))
    land_and_run(20)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(30))
    read = {f.rsplit("/", 1)[1] for f in spark.read.parquet(out).inputFiles()}
    # The files of the broken run still lie there and are not read.
    assert before - read and {p.name for p in (tmp_path / "out").glob("*.parquet")} > read
