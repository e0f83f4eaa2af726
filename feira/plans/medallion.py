"""Raw -> clean -> curated, with a quality gate behind every layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira import schemas
from feira.operators import quality
from feira.operators.clean import clean_orders, clean_reviews, clean_table
from feira.operators.keys import Split, chronological_split
from feira.operators.star import (
    build_dim_customers,
    build_dim_date,
    build_dim_order_status,
    build_dim_products,
    build_dim_sellers,
    build_fct_marketing_leads,
    build_fct_order_items,
)
from feira.session import configure, scratch_scope
from feira.sources.readers import read_optional, with_ingestion_time
from feira.sources.snapshots import SnapshotTable
from feira.streaming.archive import archive_path, archive_topics, wait_all

RAW, CLEAN, GOLD = "raw", "clean", "gold"
BATCH_FRACTION = 0.9
_CONCURRENT_TABLES = 8
# What quarters, cut-offs and time ranges are asked of.
_CLUSTERED = {
    (CLEAN, "orders"): ("order_purchase_timestamp", "order_id"),
    (GOLD, "fct_order_items"): ("order_date_key", "order_id"),
}
# Tables of items, orders and reviews, which are never the looked-up side of a join.
_PACKED = ("orders", "order_items", "order_reviews", "fct_order_items")
# A task that counts or deduplicates by a fine key, or sorts for the first row per key, holds its whole split.
_SPLIT = "32m"


class Lakehouse:
    """Versioned tables of the three layers under one base path."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = configure(spark)
        self.spark.conf.set("spark.sql.files.maxPartitionBytes", _SPLIT)
        self.base = base.rstrip("/")

    def table(self, layer: str, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.base}/{layer}/{name}")

    def read(self, layer: str, name: str) -> DataFrame:
        return self.table(layer, name).read()

    def find(self, layer: str, name: str) -> DataFrame | None:
        return self.table(layer, name).read_if_exists()

    def star(self) -> dict[str, DataFrame]:
        found = {name: self.find(GOLD, name) for name in schemas.GOLD_SCHEMAS}
        return {name: df for name, df in found.items() if df is not None}

    def archive(self, topic: str = schemas.ORDERS_TOPIC) -> DataFrame:
        """Archived messages of a topic; empty when none has been archived."""
        found = read_optional(self.spark, archive_path(self.base, topic), schemas.ARCHIVE_SCHEMA)
        return found.select(*schemas.ARCHIVE_SCHEMA.names)


def _write_all(lake: Lakehouse, layer: str, builders: Mapping[str, Callable[[], DataFrame | None]]) -> None:
    """Write independent tables side by side, so that small ones do not leave the cluster idle. A builder that
    returns None skips its table. Intermediate results go once their table stands."""

    def write(name: str) -> None:
        with scratch_scope(lake.spark):
            df = builders[name]()
            if df is not None:
                codec = "zstd" if name in _PACKED else "snappy"
                lake.table(layer, name).overwrite(df, cluster_by=_CLUSTERED.get((layer, name), ()), compression=codec)

    with ThreadPoolExecutor(_CONCURRENT_TABLES) as pool:
        list(pool.map(inheritable_thread_target(lake.spark)(write), builders))


def ingest_raw(lake: Lakehouse, sources: Mapping[str, DataFrame]) -> None:
    """Full load of the given raw tables; a table that delivers no rows is skipped."""
    def filled(df: DataFrame) -> DataFrame | None:
        return None if df.isEmpty() else with_ingestion_time(df)

    _write_all(lake, RAW, {name: (lambda df=df: filled(df)) for name, df in sources.items()})


def split_orders(orders: DataFrame, rank_col: str = "__rank") -> Split:
    """Oldest 90 % for the batch load, the rest for the stream."""
    return chronological_split(
        orders, "order_purchase_timestamp", BATCH_FRACTION, ["order_id"], rank_col=rank_col
    )


def archive_streams(lake: Lakehouse, streams: Mapping[str, DataFrame]) -> None:
    """Archive what the topics hold and stop."""
    wait_all(archive_topics(streams, lake.base, catch_up=True))


def clean_layer(lake: Lakehouse) -> None:
    def build(name: str) -> DataFrame | None:
        raw = lake.find(RAW, name)
        if raw is None:
            return None
        if name == "orders":
            return clean_orders(raw, lake.archive(), lake.read(RAW, "customers"), flag_col="is_imputed")
        return clean_reviews(raw) if name == "order_reviews" else clean_table(raw, name)

    _write_all(lake, CLEAN, {name: (lambda name=name: build(name)) for name in schemas.RAW_SCHEMAS})


def load_gold(lake: Lakehouse, leads: DataFrame | None = None, collapse_identical: bool = True) -> None:
    """Dimensions first; the facts then read the written dimensions, whose sizes the planner knows."""

    def clean(name: str) -> DataFrame:
        return lake.read(CLEAN, name)

    def dim(name: str) -> DataFrame:
        return lake.read(GOLD, name)

    _write_all(
        lake,
        GOLD,
        {
            "dim_customers": lambda: build_dim_customers(clean("customers")),
            "dim_sellers": lambda: build_dim_sellers(clean("sellers")),
            "dim_products": lambda: build_dim_products(clean("products"), clean("category_translation")),
            "dim_order_status": lambda: build_dim_order_status(clean("orders")),
            "dim_date": lambda: build_dim_date(clean("orders")),
        },
    )
    facts: dict[str, Callable[[], DataFrame]] = {
        "fct_order_items": lambda: build_fct_order_items(
            clean("order_items"),
            clean("orders"),
            clean("order_reviews"),
            dim("dim_customers"),
            dim("dim_products"),
            dim("dim_sellers"),
            dim("dim_order_status"),
            collapse_identical,
        )
    }
    if leads is not None:
        facts["fct_marketing_leads"] = lambda: build_fct_marketing_leads(leads, dim("dim_sellers"))
    _write_all(lake, GOLD, facts)


_SUITES = {RAW: quality.RAW_SUITE, CLEAN: quality.CLEAN_SUITE, GOLD: quality.GOLD_SUITE}


def check_layer(lake: Lakehouse, layer: str) -> DataFrame:
    return quality.check_layer(lake.spark, layer, _SUITES[layer], lambda name: lake.find(layer, name))


def run_medallion(
    lake: Lakehouse,
    sources: Mapping[str, DataFrame],
    streams: Mapping[str, DataFrame] | None = None,
    leads: DataFrame | None = None,
    strict: bool = True,
) -> DataFrame:
    """Load every layer in order and return the row count of every written table.

    Both raw branches, batch tables and stream archives, finish before cleaning starts. A failed gate stops the run
    after its layer.
    """
    ingest_raw(lake, sources)
    if streams:
        archive_streams(lake, streams)
    quality.gate(check_layer(lake, RAW), strict)
    clean_layer(lake)
    quality.gate(check_layer(lake, CLEAN), strict)
    load_gold(lake, leads)
    quality.gate(check_layer(lake, GOLD), strict)
    return table_counts(lake)


def table_counts(lake: Lakehouse) -> DataFrame:
    """Row counts recorded with the current version of every table."""
    parts = []
    for layer, names in ((RAW, schemas.RAW_SCHEMAS), (CLEAN, schemas.RAW_SCHEMAS), (GOLD, schemas.GOLD_SCHEMAS)):
        for name in names:
            table = lake.table(layer, name)
            if table.exists():
                latest = table.history().limit(1)
                parts.append(
                    latest.select(
                        F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.col("rows").alias("row_count")
                    )
                )
    return reduce(DataFrame.unionByName, parts)
