import pathlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from conftest import plan_of
from feira.operators import keys
from feira.operators.gaps import event_gaps
from feira.operators.keys import chronological_split, dense_key, global_rank, with_previous
from feira.plans import medallion
from feira.session import materialize, release_scratch, scratch_dir, scratch_scope

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def hot_rows(n=9000, seed=3):
    """A third of the rows share one leading value; some leading values are NULL."""
    rng = random.Random(seed)
    rows = [(("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(400):04d}"), i) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_dense_key_equals_global_order_with_a_hot_value(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, v int").repartition(7)
    got = {(r["k"], r["v"]): r["key"] for r in dense_key(df, ["k", "v"], "key").collect()}
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == {row: i + 1 for i, row in enumerate(expected)}


def test_hot_value_is_spread_over_slices(spark):
    df = spark.createDataFrame(hot_rows(), "k string, v int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = df.orderBy("k", "v").selectExpr("spark_partition_id() as p", "k")
        largest = ordered.groupBy("p").count().agg({"count": "max"}).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert largest < 3000


def test_dense_key_has_no_single_partition_step(spark):
    df = spark.createDataFrame([(1, "a")], "v int, k string")
    assert "SinglePartition" not in plan_of(dense_key(df, ["k"], "key"))


def test_empty_input(spark):
    ranked = global_rank(spark.createDataFrame([], "k string"), ["k"], "rank")
    assert ranked.rows == 0 and ranked.df.collect() == []


@FEW
@given(st.lists(st.integers(-50, 50), max_size=60))
def test_rank_is_dense(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = sorted((r["rank"], r["v"]) for r in global_rank(df, ["v"], "rank").df.collect())
    assert [g[0] for g in got] == list(range(1, len(values) + 1))
    assert [g[1] for g in got] == sorted(values)


def test_split_eleven_rows(spark):
    df = spark.createDataFrame([(f"2018-01-{d:02d} 00:00:00", d) for d in range(1, 12)], "ts string, id int")
    split = chronological_split(df, "ts", 0.9)
    assert (split.head.count(), split.tail.count(), split.rows) == (9, 2, 11)
    assert split.head.columns == ["ts", "id"]


@FEW
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=60, unique=True))
def test_split_is_ordered_and_complete(spark, pairs):
    df = spark.createDataFrame(pairs, "ts int, id int")
    split = chronological_split(df, "ts", 0.9, ["id"])
    head, tail = sorted(map(tuple, split.head.collect())), sorted(map(tuple, split.tail.collect()))
    assert len(head) == int(len(pairs) * 0.9)
    assert head + tail == sorted(pairs)


def test_previous_value_crosses_blocks(spark):
    rows = [(i, i * i) for i in range(1, 26)]
    df = spark.createDataFrame(rows, "t int, v int").repartition(5)
    for block in (1, 3, 7, 100):
        got = {r["t"]: r["before"] for r in with_previous(df, ["t"], "v", "before", block_rows=block).collect()}
        assert got == {i: (i - 1) ** 2 if i > 1 else None for i in range(1, 26)}


def test_event_gaps_with_missing_time(spark):
    df = spark.sql(
        "select * from values (1, timestamp '2024-01-01 00:00:00'), (2, timestamp '2024-01-01 00:00:01.5'), "
        "(3, cast(null as timestamp)) as t(id, ts)"
    )
    got = {r["id"]: r["gap_seconds"] for r in event_gaps(df, "ts", ["id"]).collect()}
    assert got == {3: None, 1: None, 2: 1.5}


def test_the_input_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)
    counted = spark.range(6000).select(F.udf(lambda i: seen.add(1) or i, "bigint")("id").alias("k"))
    for unique in (True, False):
        before = seen.value
        assert dense_key(counted, ["k"], "key", unique).count() == 6000
        assert seen.value - before == 6000


def test_scratch_copies_go_with_their_owner(spark):
    scratch = pathlib.Path(scratch_dir(spark)) / "feira"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    with scratch_scope(spark):
        assert dense_key(spark.range(10), ["id"], "key").count() == 10
    assert set(scratch.iterdir()) == before
    dense_key(spark.range(10), ["id"], "key").count()
    assert release_scratch(spark) > 0 and not [p for p in scratch.iterdir() if p not in before]


@pytest.mark.parametrize("order_by", [["k", "v"], ["k", "d"], ["v", "k"]])
def test_ties_collapse_in_the_exchange_that_ranks(spark, monkeypatch, order_by):
    written = []

    def watched(df, *args):
        written.append(df)
        return materialize(df, *args)

    monkeypatch.setattr(keys, "materialize", watched)
    rows = [(i % 700 or None, [float("nan"), None, 0.0, -0.0, 2.5][i % 5 if i % 7 else 4], f"d{i % 3}") for i in range(6000)]
    df = spark.createDataFrame(rows, "k int, v double, d string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = keys.global_rank(df, order_by, "rank", unique="collapse")
        columns = [*order_by, *[c for c in df.columns if c not in order_by]]
        ranked = found.df.orderBy("rank").select("rank", *columns).collect()
        expected = df.select(columns).distinct().orderBy(columns).collect()
        shown = lambda r: [str(v).replace("-0.0", "0.0") for v in r]
        assert [shown(r[1:]) for r in ranked] == [shown(r) for r in expected]
        assert [r["rank"] for r in ranked] == list(range(1, len(expected) + 1)) and found.rows == len(expected)
        if order_by[0] == "k":
            assert plan_of(written[1]).count("rangepartitioning(") == 1
            assert "hashpartitioning" not in plan_of(written[1])
            assert written[1].select("__slice").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_large_tables_are_packed_and_splits_bounded(spark, tmp_path):
    lake = medallion.Lakehouse(spark, str(tmp_path / "lake"))
    df = spark.createDataFrame([("1", 20200101)], "order_id string, order_date_key int")
    medallion._write_all(lake, medallion.GOLD, {"fct_order_items": lambda: df, "dim_date": lambda: df})
    codecs = {p.parent.parent.parent.name: p.name.split(".")[-2] for p in tmp_path.rglob("data/*/part-*.parquet")}
    assert codecs == {"fct_order_items": "zstd", "dim_date": "snappy"}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
