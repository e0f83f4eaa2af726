"""Every registered query against its independent SQL, and the layer run end to end."""

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF
from feira import schemas
from feira.operators.quality import DataQualityError
from feira.plans import adapters, medallion, registry
from feira.session import scratch_dir

# Scores and figures of trained models; their people, ranges and rules are checked by queries of their own.
ROWS_ONLY = {"churn_probabilities", "churn_probabilities_boosted", "churn_report"}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in registry.TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def shown(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value)
    return "NULL" if value is None else str(value)


def test_every_query_has_sql():
    assert set(registry.QUERIES) - set(contract.oracle_sql()) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, engine, name):
    df = contract.queries()[name](spark, SF)
    rows = df.collect()
    if name in ROWS_ONLY:
        assert rows
        return
    found = engine.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    expected = sorted(tuple(shown(r[columns.index(c)]) for c in order) for r in found.fetchall())
    assert sorted(tuple(shown(r[c]) for c in order) for r in rows) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_gate_stops_the_run(spark, tmp_path):
    lake = medallion.Lakehouse(spark, str(tmp_path / "lake"))
    broken = spark.createDataFrame([(None,) * 8], schemas.RAW_SCHEMAS["orders"])
    with pytest.raises(DataQualityError, match="raw.orders"):
        medallion.run_medallion(lake, {"orders": broken, **adapters.raw_tables(spark, SF)})
    assert lake.find(medallion.CLEAN, "orders") is None


def test_empty_source_is_skipped_and_visible(spark, tmp_path):
    lake = medallion.Lakehouse(spark, str(tmp_path / "lake"))
    sources = {"orders": adapters.raw_orders(spark, SF), "products": spark.createDataFrame([], schemas.RAW_SCHEMAS["products"])}
    medallion.ingest_raw(lake, sources)
    assert lake.find(medallion.RAW, "products") is None
    statuses = {r["table_name"]: r["constraint_status"] for r in medallion.check_layer(lake, medallion.RAW).collect()}
    assert statuses["products"] == "Skipped" and statuses["orders"] == "Success"


def test_intermediate_results_are_deleted(spark, tmp_path):
    lake = medallion.Lakehouse(spark, str(tmp_path / "lake"))
    sources = {"orders": adapters.raw_orders(spark, SF), **adapters.raw_tables(spark, SF)}
    scratch = pathlib.Path(scratch_dir(spark)) / "feira"
    medallion.ingest_raw(lake, sources)
    before = set(scratch.iterdir()) if scratch.exists() else set()
    medallion.clean_layer(lake)
    medallion.load_gold(lake)
    assert set(scratch.iterdir()) == before
    assert lake.read(medallion.GOLD, "fct_order_items").count() == lake.read(medallion.RAW, "order_items").count()


def test_run_without_streams_is_repeatable(spark, tmp_path):
    lake = medallion.Lakehouse(spark, str(tmp_path / "lake"))
    sources = {"orders": adapters.raw_orders(spark, SF), **adapters.raw_tables(spark, SF)}
    first = {tuple(r) for r in medallion.run_medallion(lake, sources).collect()}
    fact = lake.read(medallion.GOLD, "fct_order_items")
    before = sorted(map(tuple, fact.collect()))
    assert {tuple(r) for r in medallion.run_medallion(lake, sources).collect()} == first
    table = lake.table(medallion.GOLD, "fct_order_items")
    assert table.latest_version() == 1 and sorted(map(tuple, table.read().collect())) == before
