"""Raw text tables to typed, merged, imputed clean tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira import schemas
from feira.functions.casts import apply_table_casts, to_timestamp
from feira.functions.text import PORTUGUESE_STOPWORDS, clean_text
from feira.operators.groups import any_per_key, discrete_quantile, first_per_key
from feira.session import materialize

DEFAULT_REVIEW_SCORE = 3
UNKNOWN_CATEGORY = "unknown"


def parse_payload(archive: DataFrame, payload: T.StructType) -> DataFrame:
    """Archived messages to payload columns plus their place in the topic.

    Malformed JSON gives a row of NULLs, unknown fields are ignored.
    """
    parsed = archive.select(
        F.from_json("kafka_value", payload).alias("payload"), "kafka_partition", "kafka_offset"
    )
    return parsed.select("payload.*", "kafka_partition", "kafka_offset")


def parse_logistics(archive: DataFrame) -> DataFrame:
    """Typed delivery dates of the logistics topic, latest message per order."""
    messages = parse_payload(archive, schemas.LOGISTICS_PAYLOAD)
    latest = first_per_key(messages, ["order_id"], newest_first())
    dates = ("delivered_carrier_date", "delivered_customer_date", "estimated_delivery_date")
    return latest.select(
        "order_id",
        "customer_id",
        *[to_timestamp(c).alias(c) for c in dates],
    )


def newest_first() -> list:
    return [F.col("kafka_offset").desc_nulls_last(), F.col("kafka_partition").desc_nulls_last()]


def merge_batch_and_stream(
    batch: DataFrame, archive: DataFrame | None, payload: T.StructType, key: str
) -> DataFrame:
    """Batch rows and archived messages as one table with one row per key.

    The stream wins over the batch and a later offset over an earlier one; a key's messages share a partition, so
    offsets order them.
    """
    batch = batch.drop(schemas.INGESTED_AT)
    rows = batch.withColumns(
        {
            "kafka_partition": F.lit(None).cast("int"),
            "kafka_offset": F.lit(None).cast("bigint"),
            "__source": F.lit(0),
        }
    )
    if archive is not None:
        rows = rows.unionByName(parse_payload(archive, payload).withColumn("__source", F.lit(1)))
    rest = [F.col(c).asc_nulls_last() for c in batch.columns if c != key]
    order = [F.col("__source").desc(), *newest_first(), *rest]
    return first_per_key(rows, [key], order).select(batch.columns)


def median_delivery_days(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Lower median of carrier-to-customer calendar days per customer zip."""
    return discrete_quantile(
        _with_delivery_days(orders, customers), ["customer_zip_code_prefix"], "__days", "median_delivery_days"
    )


def _with_delivery_days(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with zip and transit days. One zip per customer is written first, so that the join can broadcast it by
    its true size or split a customer that owns a large part of the orders."""
    zips = materialize(
        any_per_key(customers.select("customer_id", "customer_zip_code_prefix"), ["customer_id"]), "customer-zips"
    )
    days = F.datediff("order_delivered_customer_date", "order_delivered_carrier_date")
    return orders.join(zips, "customer_id", "left").withColumn("__days", days)


def impute_delivery(
    orders: DataFrame, customers: DataFrame, fallback: str | None = None, flag_col: str | None = None
) -> DataFrame:
    """Fill a missing delivery date with carrier date + the zip's lower-median days (midnight of that day).

    Without a median for the zip the date stays NULL, unless ``fallback="global"`` supplies the overall median.
    ``flag_col`` adds a column telling which dates were filled in. The orders with their zip are written once and read
    twice: two narrow columns for the medians, then whole. The medians are written as well, so that the planner joins
    them by their true size: broadcast when small, otherwise a skew-split sort-merge join.
    """
    if fallback not in (None, "global"):
        raise ValueError(f"unknown fallback {fallback!r}")
    timed = materialize(_with_delivery_days(orders, customers), "timed-orders", "zstd")
    zip_col = "customer_zip_code_prefix"
    medians = materialize(discrete_quantile(timed, [zip_col], "__days", "__median"), "medians")
    joined = timed.join(medians, zip_col, "left")
    median = F.col("__median")
    if fallback == "global":
        # One row over the per-day counts of all orders.
        overall = discrete_quantile(timed, [], "__days", "value").agg(F.min("value").alias("value")).scalar()
        median = F.coalesce(median, overall)
    delivered, carrier = F.col("order_delivered_customer_date"), F.col("order_delivered_carrier_date")
    missing = delivered.isNull() & carrier.isNotNull()
    filled = F.date_add(F.to_date(carrier), median).cast("timestamp")
    result = F.when(missing, filled).otherwise(delivered)
    columns = [result.alias(c) if c == "order_delivered_customer_date" else F.col(c) for c in orders.columns]
    if flag_col:
        columns.append((missing & filled.isNotNull()).alias(flag_col))
    return joined.select(columns)


def clean_orders(
    batch: DataFrame, archive: DataFrame | None, customers: DataFrame, flag_col: str | None = None
) -> DataFrame:
    merged = merge_batch_and_stream(batch, archive, schemas.RAW_SCHEMAS["orders"], "order_id")
    return impute_delivery(apply_table_casts(merged, "orders"), customers, flag_col=flag_col)


def clean_reviews(raw: DataFrame, stopwords: Collection[str] = PORTUGUESE_STOPWORDS) -> DataFrame:
    typed = apply_table_casts(raw.drop(schemas.INGESTED_AT), "order_reviews")
    return typed.withColumns(
        {
            "review_comment_cleaned": clean_text("review_comment_message", stopwords),
            "review_score": F.coalesce("review_score", F.lit(DEFAULT_REVIEW_SCORE)),
        }
    )


def clean_table(raw: DataFrame, table: str) -> DataFrame:
    """Declared casts plus the table's own rules (product category default and volume)."""
    typed = apply_table_casts(raw.drop(schemas.INGESTED_AT), table)
    if table == "products":
        typed = typed.fillna({"product_category_name": UNKNOWN_CATEGORY}).withColumn(
            "product_volume_cm3",
            F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"),
        )
    return typed
