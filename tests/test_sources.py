import datetime as dt
import json

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from feira import schemas
from feira.sources import readers, sinks
from feira.sources.snapshots import SnapshotTable


def test_csv_with_mark_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    head = ",".join(schemas.RAW_SCHEMAS["order_reviews"].names)
    path.write_bytes(("﻿" + head + '\nr1,o1,5,,"a, ""x""\nb",,\n').encode())
    row = readers.read_csv(spark, str(path), schemas.RAW_SCHEMAS["order_reviews"], line_breaks=True).collect()
    assert len(row) == 1 and row[0]["review_id"] == "r1"
    assert row[0]["review_comment_message"] == 'a, "x"\nb' and row[0]["review_comment_title"] is None


def test_csv_keeps_leading_zeros_through_an_export(spark, tmp_path):
    sellers = spark.createDataFrame([("s1", "01151", 'são "x", y', None)], schemas.RAW_SCHEMAS["sellers"])
    sinks.export_csv(sellers, str(tmp_path / "out"))
    assert readers.read_csv(spark, str(tmp_path / "out"), sellers.schema).collect() == sellers.collect()


def test_every_star_table_is_exported(spark, tmp_path):
    sinks.export_star({"a": spark.range(2), "b": spark.range(3)}, str(tmp_path))
    assert spark.read.csv(str(tmp_path / "b"), header=True).count() == 3


def test_as_raw_turns_values_to_text(spark):
    df = spark.createDataFrame([("o", 40.0, 3, "x", "extra")], "order_id string, payment_value double, payment_sequential int, payment_type string, extra string")
    raw = readers.as_raw(df.selectExpr("*", "null as payment_installments"), schemas.RAW_SCHEMAS["order_payments"])
    assert raw.first().asDict() == {
        "order_id": "o",
        "payment_sequential": "3",
        "payment_type": "x",
        "payment_installments": None,
        "payment_value": "40.0",
    }


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(1, 26).selectExpr("id", "id * 2 as v").repartition(3)


def test_pages(spark, numbers):
    assert [r["id"] for r in readers.page(numbers, "id", 2, 10).collect()] == list(range(11, 21))
    assert readers.page(numbers, "id", 3, 10).first()["total_rows"] == 25
    assert readers.page(numbers, "id", 4, 10).collect() == []
    for page, size in ((0, 10), (1, 0), (1, 10_001)):
        with pytest.raises(ValueError):
            readers.page(numbers, "id", page, size)


def test_a_version_is_a_range_of_folders(spark, tmp_path):
    """Appends, an overwrite, appends on top of it, a restore and an append on top of that."""
    table = SnapshotTable(spark, str(tmp_path / "t"))

    def one(v):
        return spark.range(v, v + 1).select("id", F.lit("x").alias("version"))

    for v in range(4):
        assert table.append(one(v)) == v
    assert table.overwrite(one(4)) == 4
    assert table.append(one(5)) == 5
    assert table.restore(2) == 6
    assert table.append(one(7)) == 7
    held = [[0], [0, 1], [0, 1, 2], [0, 1, 2, 3], [4], [4, 5], [0, 1, 2], [0, 1, 2, 7]]
    for v, ids in enumerate(held):
        read = table.read(version=v)
        assert read.columns == ["id", "version"] and sorted(r["id"] for r in read.collect()) == ids
        assert {r["version"] for r in read.collect()} == {"x"}
    assert [r["rows"] for r in table.history().collect()] == [len(ids) for ids in reversed(held)]
    assert [r["since"] for r in table.versions().orderBy("version").collect()] == [0, 0, 0, 0, 4, 4, 6, 6]
    assert [r["id"] for r in table.added_since(6).collect()] == [7] and table.added_since(7).count() == 0
    assert sorted(r["id"] for r in table.added_since(5).collect()) == [0, 1, 2, 7]


def test_later_rows_are_read_from_later_folders_only(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    for v in range(3):
        table.append(spark.range(10 * v, 10 * v + 10))
    files = table.added_since(1).inputFiles()
    assert files and all("/data/version=2/" in f for f in files)


def test_clustered_files_hold_disjoint_ranges(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rows = spark.range(20_000).selectExpr("id % 500 as day", "id").repartition(4)
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")  # these few rows would end in one file
    table.overwrite(rows, cluster_by=("day", "id"))
    spark.conf.set(small, "true")
    files = table.read().groupBy(F.input_file_name()).agg(F.min("day"), F.max("day")).collect()
    spans = sorted((r[1], r[2]) for r in files)
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert "PushedFilters: [IsNotNull(day), EqualTo(day,7)]" in plan_of(table.read().filter("day = 7"))
    assert table.read().count() == 20_000


def test_pages_have_one_plan_and_run_no_job(spark):
    wide = spark.range(300_000)
    deep = readers.page(wide, "id", 29_000, 10)
    assert [r["id"] for r in deep.collect()] == list(range(289_990, 290_000))
    kinds = [plan_of(readers._slice(wide, ["id"], n, 10)).count("TakeOrderedAndProject") for n in (1, 29_000)]
    assert kinds[0] == kinds[1] > 0


def test_keyset_pages(numbers):
    first = [r["id"] for r in readers.page_after(numbers, "id", None, 10).collect()]
    assert [r["id"] for r in readers.page_after(numbers, "id", first[-1], 10).collect()] == list(range(11, 21))


def test_time_range(spark):
    rows = [(i, dt.datetime(2018, 1, 30, 12) + dt.timedelta(days=i)) for i in range(4)]
    df = spark.createDataFrame(rows, "id int, ts timestamp")

    def ids(*args, **kwargs):
        return [r["id"] for r in readers.time_range(df, "ts", *args, **kwargs).collect()]

    assert ids("2018-01-31 12:00:00", "2018-02-01 12:00:00") == [1, 2]
    assert ids(None, "2018-01-31") == [0]
    assert ids(None, "2018-01-31", end_inclusive_day=True) == [0, 1]
    assert ids("2018-02-01") == [2, 3] and ids() == [0, 1, 2, 3]


def test_lookup_and_catalog(spark, numbers):
    tables = {"orders": spark.createDataFrame([("o1", "b"), ("o1", "a")], "order_id string, s string"), "b": numbers}
    assert readers.lookup(tables, "orders", "o1").collect()[0]["s"] == "a"
    assert readers.lookup(tables, "orders", "zz").collect() == []
    with pytest.raises(KeyError):
        readers.lookup(tables, "nope", "x")
    with pytest.raises(KeyError):
        readers.lookup(tables, "b", "x")
    assert [tuple(r) for r in readers.catalog(tables).collect()] == [("b", 25), ("orders", 2)]
    assert readers.empty_like(numbers).schema == numbers.schema and readers.empty_like(numbers).count() == 0


def test_optional_read(spark, tmp_path):
    schema = schemas.RAW_SCHEMAS["sellers"]
    assert readers.read_optional(spark, str(tmp_path / "none"), schema).count() == 0
    spark.createDataFrame([("s", "1", "c", "t")], schema).write.parquet(str(tmp_path / "some"))
    assert readers.read_optional(spark, str(tmp_path / "some"), schema).count() == 1


def test_messages_keep_null_fields(spark):
    orders = spark.createDataFrame(
        [("o1", None, "shipped", "t", None, None, None, "e"), ("o2", "c2", "delivered", "t", None, "k", "d", "e"),
         ("o3", "c3", "delivered", "t", None, "k", "", "e")],
        schemas.RAW_SCHEMAS["orders"],
    )
    sent = {json.loads(r["value"])["order_id"]: r for r in sinks.order_messages(orders).collect()}
    assert sent["o1"]["key"] == "unknown" and sent["o1"]["topic"] == schemas.ORDERS_TOPIC
    body = json.loads(sent["o1"]["value"])
    assert body["order_approved_at"] is None and list(body) == schemas.RAW_SCHEMAS["orders"].names
    updates = sinks.logistics_messages(orders).collect()
    assert [json.loads(r["value"]) for r in updates] == [
        {"order_id": "o2", "customer_id": "c2", "delivered_carrier_date": "k", "delivered_customer_date": "d",
         "estimated_delivery_date": "e"}
    ]


def test_relational_order_drops_facts_first():
    assert sinks.relational_load_order(["fct_order_items", "dim_a", "dim_b"]) == [
        ("drop", "fct_order_items"), ("load", "dim_a"), ("load", "dim_b"), ("load", "fct_order_items"),
    ]


def test_relational_load_steps(spark, monkeypatch):
    done = []
    monkeypatch.setattr(sinks, "write_jdbc", lambda df, url, table, properties: done.append(("load", table)))
    sinks.load_relational({"fct_order_items": None, "dim_a": None}, "jdbc:x", lambda t: done.append(("drop", t)))
    assert done == [("drop", "fct_order_items"), ("load", "dim_a"), ("load", "fct_order_items")]


def test_versions(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.read_if_exists() is None
    with pytest.raises(ValueError):
        table.read()

    def frame(*rows):
        return spark.createDataFrame(list(rows), "id int, s string")

    def rows(df):
        return sorted(map(tuple, df.collect()))

    assert table.overwrite(frame((1, "a"), (2, "b"))) == 0
    assert table.row_counts().count() == 0
    assert table.append(frame((3, "c"))) == 1
    assert rows(table.read()) == [(1, "a"), (2, "b"), (3, "c")] and rows(table.added_since(0)) == [(3, "c")]
    assert table.overwrite(frame((1, "a"), (2, "x"), (4, "d")), "MERGE", reason="test") == 2
    assert rows(table.diff("id", 1, 2)) == [(2, "changed"), (3, "removed"), (4, "added")]
    assert rows(table.added_since(1)) == [(2, "x"), (4, "d")]
    assert rows(table.row_counts()) == [(1, 3), (2, 3)]
    assert table.restore(0) == 3 and rows(table.read()) == [(1, "a"), (2, "b")]
    assert rows(table.read(version=2)) == [(1, "a"), (2, "x"), (4, "d")]
    log = table.history().collect()
    assert [(r["version"], r["operation"], r["rows"]) for r in log] == [
        (3, "RESTORE", 2), (2, "MERGE", 3), (1, "WRITE", 3), (0, "WRITE", 2),
    ]
    assert log[1]["parameters"] == {"mode": "Overwrite", "reason": "test"}
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    micros = table.versions().orderBy("version").select(F.unix_micros("timestamp")).collect()
    times = [epoch + dt.timedelta(microseconds=r[0]) for r in micros]
    assert rows(table.read(as_of=times[1])) == rows(table.read(version=1))
    assert rows(table.read(as_of=times[2] - dt.timedelta(microseconds=1))) == rows(table.read(version=1))
    assert rows(table.read(as_of="2999-01-01")) == rows(table.read())
    with pytest.raises(ValueError):
        table.read(as_of=times[0] - dt.timedelta(seconds=1))
    with pytest.raises(ValueError):
        table.read(version=9)
    with pytest.raises(ValueError):
        table.read(version=1, as_of="2999-01-01")
    with pytest.raises(ValueError):
        table.append(spark.range(1))
    assert table.overwrite(spark.range(2)) == 4 and table.read().columns == ["id"]


def test_unfinished_commit_is_invisible_and_replaced(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(3))
    spark.range(99).write.parquet(table._folder(1))
    assert table.latest_version() == 0 and table.read().count() == 3
    assert table.overwrite(spark.range(4)) == 1 and table.read().count() == 4
