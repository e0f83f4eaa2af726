"""The registered queries: every operator over the whole of the driver's tables."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira import schemas
from feira.functions.casts import apply_table_casts, iso_timestamp
from feira.functions.text import clean_text
from feira.operators import churn, clean, logistics, quality, reviews, sales, scd, scoring, star
from feira.operators.gaps import event_gaps
from feira.operators.keys import Split
from feira.plans import adapters, medallion
from feira.session import materialize, scratch_path
from feira.sources import readers, sinks
from feira.sources.pages import PageIndex
from feira.sources.snapshots import SnapshotTable
from feira.streaming import archive, clean_feed, ordered

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

RANGE = ("1996-01-01", "1996-03-31")
LOOKUP_VALUE = "0000000077"
ANALYSIS_DATE = "2002-01-01"
CHURN_CUTOFF = "2001-01-01"
CHANNEL_QUARTER = (1998, 3)
#: Published models, as data: their results can be checked without fitting anything.
CHURN_POINTS = (
    scoring.LogisticPoint("constant", 0.0, dict.fromkeys(churn.FEATURES, 0.0)),
    scoring.LogisticPoint(
        "published",
        -1.5,
        {
            "recency_days": 0.004,
            "frequency": -0.12,
            "monetary": -2e-6,
            "delivery_delay_days": 0.03,
            "freight_ratio": 0.5,
            "avg_review_score": -0.2,
            "max_installments": 0.05,
        },
    ),
    scoring.LogisticPoint("recency", 0.5, {"recency_days": 0.001, "frequency": -0.05}),
)
CHURN_TREES = scoring.Ensemble(
    (
        scoring.Node(0, 1, "recency_days", 120.5, 2, 3, None),
        scoring.Node(0, 2, "frequency", 6.5, 4, 5, None),
        scoring.Node(0, 3, None, None, None, None, 0.8),
        scoring.Node(0, 4, None, None, None, None, 0.1),
        scoring.Node(0, 5, None, None, None, None, -0.7),
        scoring.Node(1, 1, "avg_review_score", 3.25, 2, 3, None),
        scoring.Node(1, 2, "monetary", 250000.0, 4, 5, None),
        scoring.Node(1, 3, None, None, None, None, -0.25),
        scoring.Node(1, 4, None, None, None, None, 0.4),
        scoring.Node(1, 5, "delivery_delay_days", 1.5, 6, 7, None),
        scoring.Node(1, 6, None, None, None, None, -0.1),
        scoring.Node(1, 7, None, None, None, None, 0.3),
    ),
    (1.0, 0.1),
)
#: The campaign calls this share of all people.
ALERT_SHARE = 10
PHRASES = ("atraso", "nunca chegou", "the", "le la")

_built: dict[tuple, object] = {}
_lock = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """Written tables and models shared by the queries of one session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _built:
            _built[key] = build()
        return _built[key]


def plain(df: DataFrame) -> DataFrame:
    """Report types: decimals as doubles, dates and times as text."""

    def shown(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        return col.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


# Shared inputs ------------------------------------------------------------------------------------------------------


def order_split(spark: SparkSession, sf_dir: str) -> Split:
    return _once(
        spark,
        sf_dir,
        "split",
        lambda: medallion.split_orders(adapters.raw_orders(spark, sf_dir), rank_col="rank"),
    )


_CARRIED = ["rank", "order_purchase_timestamp"]


def _topic(messages: DataFrame) -> DataFrame:
    return adapters.as_topic(messages, F.col("rank"), F.col("order_purchase_timestamp"))


def _order_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topic(sinks.order_messages(order_split(spark, sf_dir).tail, _CARRIED))


def _logistics_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = order_split(spark, sf_dir).tail
    return _topic(sinks.logistics_messages(tail, _CARRIED))


def _landed(spark: SparkSession, topic: DataFrame, name: str) -> DataFrame:
    """A topic written as files and opened as a stream."""
    path = scratch_path(spark, f"topic-{name}")
    topic.write.parquet(path, compression="zstd")
    return archive.file_stream(spark, path)


def lakehouse(spark: SparkSession, sf_dir: str) -> medallion.Lakehouse:
    """All three layers built from the driver's tables, once per session."""

    def build() -> medallion.Lakehouse:
        lake = medallion.Lakehouse(spark, scratch_path(spark, "lake"))
        head = order_split(spark, sf_dir).head.drop("rank")
        medallion.run_medallion(
            lake,
            {"orders": head, **adapters.raw_tables(spark, sf_dir)},
            {
                schemas.ORDERS_TOPIC: _landed(spark, _order_topic(spark, sf_dir), "orders"),
                schemas.LOGISTICS_TOPIC: _landed(spark, _logistics_topic(spark, sf_dir), "logistics"),
            },
            adapters.marketing_leads(spark, sf_dir),
        )
        return lake

    return _once(spark, sf_dir, "lake", build)


def _gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return lakehouse(spark, sf_dir).read(medallion.GOLD, name)


def _clean(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return lakehouse(spark, sf_dir).read(medallion.CLEAN, name)


def _on_star(operator: Callable[..., DataFrame], *tables: str, **options) -> Query:
    """A query that hands curated (or ``clean:``) tables to an operator."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = [
            _clean(spark, sf_dir, t.removeprefix("clean:")) if t.startswith("clean:") else _gold(spark, sf_dir, t)
            for t in tables
        ]
        return plain(operator(*inputs, **options))

    return run


def _typed(name: str, raw: Query) -> Query:
    return lambda spark, sf_dir: plain(clean.clean_table(raw(spark, sf_dir), name))


# Sources and sinks --------------------------------------------------------------------------------------------------


def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.catalog({t: adapters.load(spark, sf_dir, t) for t in TABLES})


def page_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.page(adapters.raw_orders(spark, sf_dir), "order_id", page=3, size=100)


def page_orders_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last page but one, from the page index."""
    index = PageIndex(adapters.raw_orders(spark, sf_dir), ["order_id"])
    return index.page(index.pages(100) - 1, 100)


def lookup_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.lookup({"orders": adapters.raw_orders(spark, sf_dir)}, "orders", LOOKUP_VALUE)


def _written_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders as a written table, so that bounds reach its scan."""
    typed = apply_table_casts(adapters.raw_orders(spark, sf_dir), "orders")
    return _once(spark, sf_dir, "typed_orders", lambda: materialize(typed, "typed-orders"))


def orders_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(readers.in_range(_written_orders(spark, sf_dir), "order_purchase_timestamp", *RANGE))


def orders_in_range_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(readers.time_range(_written_orders(spark, sf_dir), "order_purchase_timestamp", *RANGE, page=2, size=50))


def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.schema_rows({t: adapters.load(spark, sf_dir, t) for t in ("orders", "events", "customer")})
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, type string")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.export_csv(adapters.raw_products(spark, sf_dir), path)
    return readers.read_csv(spark, path, schemas.RAW_SCHEMAS["products"])


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as CSV and read back: line breaks, commas and quotes inside values, many tasks a file."""
    path = scratch_path(spark, "csv")
    documents = adapters.load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    sinks.export_csv(documents, path)
    shape = T.StructType([T.StructField(c, T.StringType()) for c in documents.columns])
    return readers.read_csv(spark, path, shape, line_breaks=True)


def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = medallion.Lakehouse(spark, scratch_path(spark, "raw"))
    medallion.ingest_raw(lake, {"orders": adapters.raw_orders(spark, sf_dir)})
    stored = lake.read(medallion.RAW, "orders")
    return stored.withColumn("has_time", F.col(schemas.INGESTED_AT).isNotNull()).drop(schemas.INGESTED_AT)


def split_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_split(spark, sf_dir).head.select("rank", "order_id", "order_purchase_timestamp")


def split_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_split(spark, sf_dir).tail.select("rank", "order_id", "order_purchase_timestamp")


def _archived(topic: DataFrame) -> DataFrame:
    return archive.envelope(topic)


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _archived(_order_topic(spark, sf_dir))
    parsed = clean.parse_payload(stored, schemas.RAW_SCHEMAS["orders"])
    return parsed.withColumn("is_keyed", F.col("customer_id").isNotNull())


def logistics_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.parse_payload(_archived(_logistics_topic(spark, sf_dir)), schemas.LOGISTICS_PAYLOAD)


def parse_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(clean.parse_logistics(lakehouse(spark, sf_dir).archive(schemas.LOGISTICS_TOPIC)))


# Streams ------------------------------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = adapters.load(spark, sf_dir, "events").schema
    return adapters.event_topic(archive.file_stream(spark, f"{sf_dir}/events.parquet", schema))


def archive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all events twice from one checkpoint; the second run must add nothing."""
    path, checkpoint = scratch_path(spark, "archive"), scratch_path(spark, "archive-checkpoint")
    for _ in range(2):
        stream = archive.envelope(_event_stream(spark, sf_dir))
        archive.start_append(stream, path, checkpoint, catch_up=True, partition_by="kafka_topic").awaitTermination()
    return plain(spark.read.schema(schemas.ARCHIVE_SCHEMA).parquet(path).drop(schemas.INGESTED_AT))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events landed in four parts, the newest first, each streamed by a run of its own from one checkpoint and
    delivered twice; one row each."""
    events = adapters.load(spark, sf_dir, "events")
    seconds = F.unix_timestamp("ts")
    cuts = events.select(seconds.cast("double").alias("s")).approxQuantile("s", [0.25, 0.5, 0.75], 0.01)
    part = sum((F.when(seconds > c, 1).otherwise(0) for c in cuts), F.lit(0))
    landed, path, checkpoint = (scratch_path(spark, n) for n in ("events", "dedup", "dedup-checkpoint"))

    def delivery() -> DataFrame:
        return adapters.event_topic(archive.file_stream(spark, landed, events.schema))

    for number in range(len(cuts), -1, -1):
        events.filter(part == number).write.mode("append").parquet(landed)
        unique = archive.deduplicate_replays(delivery().unionByName(delivery()), "offset")
        rows = unique.select("offset", "topic", F.col("value").cast("string").alias("value"))
        archive.start_append(rows, path, checkpoint, catch_up=True).awaitTermination()
    return spark.read.parquet(path)


def _order_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's orders, every shipped one followed by a message that delivers it."""
    split = order_split(spark, sf_dir)
    shipped = split.tail.filter(F.col("order_status") == "shipped")
    later = shipped.withColumns({"order_status": F.lit("delivered"), "rank": F.col("rank") + split.rows})
    return sinks.order_messages(split.tail.unionByName(later), _CARRIED)


def _numbered_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a topic with offsets 0, 1, ... per partition, as a broker gives them, written as it is to land."""
    topic = _topic(_order_news(spark, sf_dir))
    offset = F.row_number().over(W.partitionBy("partition").orderBy("offset")) - 1
    return materialize(topic.withColumn("offset", offset.cast("bigint")), "numbered-topic")


def _land_backwards(topic: DataFrame, landed: str) -> Iterator[None]:
    """Three landings, the latest offsets first."""
    third = F.floor(F.col("offset") * 3 / (F.max("offset").over(W.partitionBy("partition")) + 1))
    parts = materialize(topic.withColumn("third", third), "landing")
    for number in (2, 1, 0):
        parts.filter(F.col("third") == number).drop("third").write.mode("append").parquet(landed)
        yield


def ordered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages landed backwards, released per partition in the order of their offsets."""
    topic = _numbered_topic(spark, sf_dir)
    landed, path, checkpoint = (scratch_path(spark, n) for n in ("news", "ordered", "ordered-checkpoint"))
    for _ in _land_backwards(topic, landed):
        stream = archive.envelope(archive.file_stream(spark, landed)).drop(schemas.INGESTED_AT)
        released = ordered.in_order(stream, ["kafka_partition"], "kafka_offset")
        archive.start_append(released, path, checkpoint, catch_up=True).awaitTermination()
    order_id = F.get_json_object("kafka_value", "$.order_id").alias("order_id")
    status = F.get_json_object("kafka_value", "$.order_status").alias("order_status")
    return spark.read.parquet(path).select(order_id, status, "kafka_partition", "kafka_offset", ordered.PLACE)


def clean_feed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders kept by a stream whose messages land backwards and are all replayed in the end, with a fold on the
    way and one batch written once more."""
    topic, payload = _numbered_topic(spark, sf_dir), schemas.RAW_SCHEMAS["orders"]
    landed, path, checkpoint = (scratch_path(spark, n) for n in ("news", "feed", "feed-checkpoint"))

    def run() -> None:
        stream = archive.envelope(archive.file_stream(spark, landed))
        clean_feed.start_clean_feed(stream, path, checkpoint, payload, "orders", "order_id", True).awaitTermination()

    for _ in _land_backwards(topic, landed):
        run()
    clean_feed.fold(spark, path, "order_id")
    topic.write.mode("append").parquet(landed)
    run()
    again = archive.envelope(topic.filter("offset % 2 = 0"))
    clean_feed.write_batch(again, 1, path, payload, "orders", "order_id")
    head = apply_table_casts(order_split(spark, sf_dir).head.drop("rank"), "orders")
    return plain(clean_feed.read_clean_feed(spark, path, "order_id", head))


# Clean layer --------------------------------------------------------------------------------------------------------


def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch plus the archived stream, in which every shipped order is followed by a message that delivers it."""
    split = order_split(spark, sf_dir)
    stored = _archived(_topic(_order_news(spark, sf_dir)))
    return clean.merge_batch_and_stream(
        split.head.drop("rank"), stored, schemas.RAW_SCHEMAS["orders"], "order_id"
    )


def _typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_table_casts(adapters.raw_orders(spark, sf_dir), "orders")


def median_by_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.median_delivery_days(_typed_orders(spark, sf_dir), adapters.raw_customers(spark, sf_dir))


def impute_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = adapters.raw_customers(spark, sf_dir)
    return plain(clean.impute_delivery(_typed_orders(spark, sf_dir), customers, flag_col="is_imputed"))


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.load(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("cleaned"))


def clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.load(spark, sf_dir, "pages").select("page_id", clean_text("html").alias("cleaned"))


def clean_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean.clean_reviews(adapters.raw_order_reviews(spark, sf_dir))
    return plain(cleaned.drop("review_comment_title", "review_comment_message"))


def latest_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = apply_table_casts(adapters.raw_order_reviews(spark, sf_dir), "order_reviews")
    return plain(
        star.latest_review_per_order(typed).select(
            "order_id", "review_id", "review_score", "review_answer_timestamp"
        )
    )


# Star schema --------------------------------------------------------------------------------------------------------


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_dim_customers(adapters.raw_customers(spark, sf_dir))


def dim_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_dim_sellers(adapters.raw_sellers(spark, sf_dir))


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = clean.clean_table(adapters.raw_products(spark, sf_dir), "products")
    return star.build_dim_products(products, adapters.raw_category_translation(spark, sf_dir))


def dim_order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_dim_order_status(adapters.raw_orders(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star.build_dim_date(_clean(spark, sf_dir, "orders")))


def dim_date_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star.build_dim_date(_clean(spark, sf_dir, "orders"), calendar="contiguous"))


def _fact(spark: SparkSession, sf_dir: str, collapse_identical: bool) -> DataFrame:
    items = clean.clean_table(adapters.raw_order_items(spark, sf_dir, with_repeats=True), "order_items")
    dims = ("dim_customers", "dim_products", "dim_sellers", "dim_order_status")
    return plain(
        star.build_fct_order_items(
            items,
            _clean(spark, sf_dir, "orders"),
            _clean(spark, sf_dir, "order_reviews"),
            *[_gold(spark, sf_dir, d) for d in dims],
            collapse_identical=collapse_identical,
        )
    )


def fct_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, collapse_identical=True)


def fct_order_items_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, collapse_identical=False)


def fct_marketing_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_fct_marketing_leads(
        adapters.marketing_leads(spark, sf_dir), _gold(spark, sf_dir, "dim_sellers")
    )


def scd2_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a negative balance move in June 2017; those deep in debt move back in March 2018."""
    customer = adapters.load(spark, sf_dir, "customer")
    home, away = F.col("c_nationkey"), (F.col("c_nationkey") + 1) % 25
    key = F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("customer_id")

    def state(nation, at: str) -> DataFrame:
        return customer.select(
            key, nation.cast("int").alias("nation"), F.lit(at).cast("timestamp").alias("changed_at")
        )

    debt, deep = F.col("c_acctbal") < 0, F.col("c_acctbal") < -500
    moved = state(F.when(debt, away).otherwise(home), "2017-06-01")
    back = state(F.when(debt & ~deep, away).otherwise(home), "2018-03-01")
    first = scd.start_history(state(home, "2016-01-01"), "customer_id", ["nation"], "2016-01-01")
    return plain(scd.scd2_merge(first, moved.unionByName(back), "customer_id", ["nation"], "changed_at"))


# Quality ------------------------------------------------------------------------------------------------------------

_RESULT = ["layer", "table_name", "constraint_name", "metric", "constraint_status"]


def _layer_quality(layer: str) -> Query:
    return lambda spark, sf_dir: medallion.check_layer(lakehouse(spark, sf_dir), layer).select(_RESULT)


def dq_relational(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = lakehouse(spark, sf_dir)
    return quality.check_layer(
        spark, medallion.GOLD, quality.RELATIONAL_SUITE, lambda name: lake.find(medallion.GOLD, name)
    ).select(_RESULT)


DEFECTS = (
    quality.Complete("order_approved_at"),
    quality.Unique("customer_id"),
    quality.Satisfies("order_approved_at <= order_delivered_carrier_date"),
    quality.MaxLength("order_status", 8),
)


def dq_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_table(adapters.raw_orders(spark, sf_dir), medallion.RAW, "orders", DEFECTS).select(_RESULT)


def fk_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = lakehouse(spark, sf_dir).star()
    return quality.foreign_key_violations(tables["fct_order_items"], tables)


# Versioned tables ---------------------------------------------------------------------------------------------------


def _versions(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    """0: batch orders, 1: stream orders appended, 2: canceled dropped and shipped delivered, 3: back to 1."""

    def build() -> SnapshotTable:
        split = order_split(spark, sf_dir)
        table = SnapshotTable(spark, scratch_path(spark, "versions"))
        table.overwrite(split.head.select("order_id", "order_status"))
        table.append(split.tail.select("order_id", "order_status"))
        status = F.col("order_status")
        table.overwrite(
            table.read()
            .filter(status != "canceled")
            .withColumn("order_status", F.when(status == "shipped", "delivered").otherwise(status))
        )
        table.restore(1)
        return table

    return _once(spark, sf_dir, "versions", build)


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).history().select("version", "operation", "rows")


def as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).read(version=0)


def as_of_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _versions(spark, sf_dir)
    committed = table.history().filter("version = 2").select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return table.read(as_of=committed.first()[0])


def version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).row_counts()


def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).diff("order_id", 0, 2)


def restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).read()


def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).added_since(0)


def medallion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.table_counts(lakehouse(spark, sf_dir))


# Reports ------------------------------------------------------------------------------------------------------------


def lane_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = logistics.lane_distance(
        _gold(spark, sf_dir, "fct_order_items"),
        _gold(spark, sf_dir, "dim_sellers"),
        _gold(spark, sf_dir, "dim_customers"),
        _clean(spark, sf_dir, "geolocation"),
    )
    return lanes.withColumn("distance_km", F.floor("distance_km"))


def score_delay_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reviews.score_delay_correlation(_gold(spark, sf_dir, "fct_order_items"))
    return found.withColumn("correlation", F.round("correlation", 6))


def gaps_between_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    events = adapters.load(spark, sf_dir, "events").select("event_id", iso_timestamp(iso).alias("ts"))
    return event_gaps(events, "ts", ["event_id"]).drop("ts")


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark,
        sf_dir,
        "training",
        lambda: materialize(
            churn.training_table(
                _gold(spark, sf_dir, "fct_order_items"),
                _clean(spark, sf_dir, "order_payments"),
                _clean(spark, sf_dir, "orders"),
                _clean(spark, sf_dir, "order_reviews"),
                _gold(spark, sf_dir, "dim_customers"),
                CHURN_CUTOFF,
            ),
            "churn-features",
        ),
    )


_KINDS = ("logistic", "boosted")


def _model(spark: SparkSession, sf_dir: str, kind: str) -> churn.ChurnModel:
    train = {"logistic": churn.train_logistic, "boosted": churn.train_boosted}[kind]
    return _once(spark, sf_dir, kind, lambda: train(_training(spark, sf_dir)))


def _churn_scores(spark: SparkSession, sf_dir: str, kind: str = "logistic") -> DataFrame:
    return churn.score(_training(spark, sf_dir), _model(spark, sf_dir, kind))


def churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir)


def churn_features_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = churn.standardised(_training(spark, sf_dir))
    return scaled.select("customer_unique_id", *[(F.round(f, 4) + 0.0).alias(f) for f in churn.FEATURES])


def _published_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the published point, written; rounded, so that many people tie."""
    score = F.round(CHURN_POINTS[1].probability(), 4).alias("churn_probability")
    return _once(
        spark,
        sf_dir,
        "published",
        lambda: materialize(_training(spark, sf_dir).select("customer_unique_id", "churned", score), "churn-published"),
    )


def _checked_scores(spark: SparkSession, sf_dir: str, kind: str, published: Column) -> DataFrame:
    """Every person once, with the published score, and whether the fitted model's score is a probability."""
    table = _training(spark, sf_dir).withColumn("published", F.round(published, 9))
    fitted = F.col("churn_probability").between(0.0, 1.0).alias("is_probability")
    scores = churn.score(table, _model(spark, sf_dir, kind), ["published"])
    return scores.select("customer_unique_id", fitted, F.col("published").alias("churn_probability"))


def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_scores(spark, sf_dir, "logistic", CHURN_POINTS[1].probability())


def churn_scores_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_scores(spark, sf_dir, "boosted", scoring.boosted_probability(CHURN_TREES))


def churn_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-weighted log-loss of the published points and its derivative by every coefficient."""
    weighted = churn.with_weights(_training(spark, sf_dir))
    found = scoring.logistic_loss(weighted, CHURN_POINTS, "churned", F.col("weight"))
    return found.select("point", F.round("loss", 6).alias("loss"), F.explode("gradient").alias("feature", "slope")).select(
        "point", "loss", "feature", (F.round("slope", 4) + 0.0).alias("slope")
    )


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.pr_curve(_published_scores(spark, sf_dir), "churn_probability", "churned")


def churn_pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = {c: F.round(c, 9) for c in ("precision", "recall")}
    return _curve(spark, sf_dir).withColumns(rounded)


def churn_pr_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = materialize(_curve(spark, sf_dir), "pr-curve")
    best = scoring.best_threshold(curve).select("threshold", F.round("f1", 9).alias("f1"))
    return scoring.pr_area(curve).select(F.round("area", 9).alias("area")).join(best, F.lit(True))


def churn_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _churn_scores(spark, sf_dir)


def churn_probabilities_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _churn_scores(spark, sf_dir, "boosted")


def churn_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People each model was trained and measured on; both share the held-back people."""
    table = _training(spark, sf_dir).withColumn("held", churn.is_held_back())
    counts = table.agg(
        F.count_if(~F.col("held")).alias("training_people"),
        F.count_if("held").alias("test_people"),
        F.count_if(F.col("held") & (F.col("churned") == 0)).alias("loyal_test_people"),
    )
    kinds = F.array(
        *[
            F.struct(F.lit(k).alias("model"), F.lit(len(_model(spark, sf_dir, k).features)).alias("features"))
            for k in _KINDS
        ]
    )
    return counts.select(F.inline(kinds), *counts.columns)


def churn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model: features, area under the precision-recall curve and share of loyal people found, both on held-back
    people, and whether the model separates at all."""
    found = [(kind, _model(spark, sf_dir, kind)) for kind in _KINDS]
    rows = [(k, ", ".join(m.features), m.pr_auc, churn.CHANCE, m.loyal_recall, m.degenerate) for k, m in found]
    return spark.createDataFrame(
        rows, "model string, features string, pr_auc double, chance double, loyal_recall double, degenerate boolean"
    )


def churn_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People from the threshold on at which precision and recall are best together."""
    threshold = scoring.best_threshold(_curve(spark, sf_dir)).first().threshold
    scores = _published_scores(spark, sf_dir).drop("churned")
    return scores.filter(F.col("churn_probability") >= F.lit(threshold))


def churn_alert_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth of all people that is most likely to leave, ties by id."""
    scores = _published_scores(spark, sf_dir).drop("churned")
    return scoring.top_rows(scores, "churn_probability", ["customer_unique_id"], scores.count() // ALERT_SHARE)


def on_time_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-time rate in orders, with and without filled-in delivery dates."""
    orders = _clean(spark, sf_dir, "orders")
    every = logistics.on_time_orders(orders).withColumn("with_imputed", F.lit(True))
    return every.unionByName(logistics.on_time_orders(orders, "is_imputed").withColumn("with_imputed", F.lit(False)))


FACT = "fct_order_items"

QUERIES: dict[str, Query] = {
    "catalog_counts": catalog_counts,
    "page_orders": page_orders,
    "page_orders_deep": page_orders_deep,
    "lookup_order": lookup_order,
    "orders_in_range": orders_in_range,
    "orders_in_range_page": orders_in_range_page,
    "table_schemas": table_schemas,
    "csv_roundtrip": csv_roundtrip,
    "csv_line_breaks": csv_line_breaks,
    "raw_ingest": raw_ingest,
    "split_batch": split_batch,
    "split_stream": split_stream,
    "order_messages": order_messages,
    "logistics_messages": logistics_messages,
    "archive_stream": archive_stream,
    "stream_dedup": stream_dedup,
    "ordered_messages": ordered_messages,
    "clean_feed_orders": clean_feed_orders,
    "merge_orders": merge_orders,
    "parse_logistics": parse_logistics,
    "typed_items": _typed("order_items", adapters.raw_order_items),
    "typed_products": _typed("products", adapters.raw_products),
    "typed_payments": _typed("order_payments", adapters.raw_order_payments),
    "typed_geo": _typed("geolocation", adapters.raw_geolocation),
    "median_by_zip": median_by_zip,
    "impute_delivery": impute_delivery,
    "clean_text": clean_documents,
    "clean_html": clean_html,
    "clean_reviews": clean_reviews,
    "latest_review": latest_review,
    "dim_customers": dim_customers,
    "dim_sellers": dim_sellers,
    "dim_products": dim_products,
    "dim_order_status": dim_order_status,
    "dim_date": dim_date,
    "dim_date_contiguous": dim_date_contiguous,
    "fct_order_items": fct_order_items,
    "fct_order_items_full": fct_order_items_full,
    "fct_marketing_leads": fct_marketing_leads,
    "scd2_customers": scd2_customers,
    "dq_raw": _layer_quality(medallion.RAW),
    "dq_clean": _layer_quality(medallion.CLEAN),
    "dq_gold": _layer_quality(medallion.GOLD),
    "dq_relational": dq_relational,
    "dq_defects": dq_defects,
    "fk_integrity": fk_integrity,
    "snapshot_history": snapshot_history,
    "as_of_version": as_of_version,
    "as_of_timestamp": as_of_timestamp,
    "version_counts": version_counts,
    "version_diff": version_diff,
    "restore": restore,
    "incremental_rows": incremental_rows,
    "medallion_counts": medallion_counts,
    "category_funnel": _on_star(sales.category_funnel, FACT, "dim_products"),
    "category_rank": _on_star(sales.category_rank, FACT, "dim_products"),
    "aov": _on_star(sales.average_order_value, FACT, "dim_order_status"),
    "payment_mix": _on_star(sales.payment_mix, "clean:order_payments"),
    "state_share": _on_star(sales.state_share, FACT, "dim_customers"),
    "geo_grid": _on_star(logistics.geo_grid, FACT, "dim_customers", "clean:geolocation"),
    "geo_grid_sellers": _on_star(logistics.geo_grid, FACT, "dim_sellers", "clean:geolocation", party="seller"),
    "lane_distance": lane_distance,
    "state_lanes": _on_star(
        logistics.state_lane_distance, FACT, "dim_sellers", "dim_customers", "clean:geolocation"
    ),
    "on_time_orders": on_time_orders,
    "seller_processing": _on_star(logistics.seller_processing, FACT, "dim_sellers"),
    "lane_shipping": _on_star(logistics.lane_shipping, FACT, "dim_sellers", "dim_customers"),
    "on_time_rate": _on_star(logistics.on_time_rate, FACT),
    "score_dist": _on_star(reviews.score_distribution, FACT),
    "score_vs_delay": _on_star(reviews.score_vs_delay, FACT),
    "score_delay_corr": score_delay_corr,
    "negative_words": _on_star(reviews.negative_words, "clean:order_reviews"),
    "keyword_mentions": _on_star(reviews.keyword_mentions, "clean:order_reviews", phrases=PHRASES),
    "one_time_buyers": _on_star(sales.one_time_buyers, "clean:orders", "dim_customers"),
    "ytd_mom": _on_star(sales.monthly_trend, FACT),
    "subtotals": _on_star(sales.date_subtotals, FACT, "dim_date"),
    "place_subtotals": _on_star(sales.place_subtotals, FACT, "dim_customers"),
    "channel_seller": _on_star(
        sales.channel_sellers,
        FACT,
        "fct_marketing_leads",
        "dim_sellers",
        year=CHANNEL_QUARTER[0],
        quarter=CHANNEL_QUARTER[1],
    ),
    "event_gaps": gaps_between_events,
    "rfm": _on_star(churn.rfm, FACT, "dim_customers", analysis_date=ANALYSIS_DATE),
    "friction": _on_star(churn.friction, FACT, "dim_customers"),
    "experience": _on_star(churn.experience, FACT, "clean:order_payments", "dim_customers"),
    "churn_label": _on_star(churn.churn_label, "clean:orders", "dim_customers", cutoff=CHURN_CUTOFF),
    "churn_features": churn_features,
    "churn_features_scaled": churn_features_scaled,
    "churn_scores": churn_scores,
    "churn_scores_boosted": churn_scores_boosted,
    "churn_probabilities": churn_probabilities,
    "churn_probabilities_boosted": churn_probabilities_boosted,
    "churn_gradient": churn_gradient,
    "churn_pr_curve": churn_pr_curve,
    "churn_pr_area": churn_pr_area,
    "churn_alerts": churn_alerts,
    "churn_alert_list": churn_alert_list,
    "churn_models": churn_models,
    "churn_report": churn_report,
}
