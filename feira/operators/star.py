"""Star schema: five dimensions, the order-item fact and the marketing-leads fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.dates import date_key, hours_between, is_fixed_holiday, whole_days_between
from feira.operators.clean import DEFAULT_REVIEW_SCORE
from feira.operators.groups import any_per_key, first_per_key
from feira.operators.keys import dense_key
from feira.schemas import conform
from feira.session import materialize


def build_dim_customers(customers: DataFrame) -> DataFrame:
    columns = [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ]
    unique = any_per_key(customers.select(columns), ["customer_id"])
    return conform(dense_key(unique, ["customer_id"], "customer_key", unique=True), "dim_customers")


def build_dim_sellers(sellers: DataFrame) -> DataFrame:
    unique = any_per_key(
        sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"), ["seller_id"]
    )
    return conform(dense_key(unique, ["seller_id"], "seller_key", unique=True), "dim_sellers")


def build_dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category where a translation exists, the original name elsewhere."""
    pairs = translation.select("product_category_name", "product_category_name_english")
    names = materialize(any_per_key(pairs, ["product_category_name"]), "translations")
    english = F.coalesce("product_category_name_english", "product_category_name")
    described = products.join(names, "product_category_name", "left").select(
        "product_id",
        english.alias("product_category_english"),
        "product_weight_g",
        "product_length_cm",
        "product_volume_cm3",
    )
    unique = any_per_key(described, ["product_id"])
    return conform(dense_key(unique, ["product_id"], "product_key", unique=True), "dim_products")


def build_dim_order_status(orders: DataFrame) -> DataFrame:
    names = orders.select(F.col("order_status").alias("status_name")).distinct()
    return conform(dense_key(names, ["status_name"], "status_key", unique=True), "dim_order_status")


def build_dim_date(orders: DataFrame, calendar: str = "occurring") -> DataFrame:
    """Dates that occur as purchase, estimate or delivery; ``calendar="contiguous"`` fills the days between.

    One pass over the orders: the three dates are exploded and deduplicated on the map side.
    """
    columns = ("order_purchase_timestamp", "order_estimated_delivery_date", "order_delivered_customer_date")
    dates = (
        orders.select(F.explode(F.array(*[F.to_date(c) for c in columns])).alias("full_date"))
        .filter(F.col("full_date").isNotNull())
        .distinct()
    )
    if calendar == "contiguous":
        span = dates.agg(F.min("full_date").alias("first"), F.max("full_date").alias("last"))
        dates = span.filter(F.col("first").isNotNull()).select(
            F.explode(F.sequence("first", "last")).alias("full_date")
        )
    elif calendar != "occurring":
        raise ValueError(f"unknown calendar {calendar!r}")
    described = dates.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.date_format("full_date", "EEEE").alias("day_of_week"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        is_fixed_holiday("full_date").alias("is_holiday_brazil"),
    )
    return conform(described, "dim_date")


def latest_review_per_order(reviews: DataFrame) -> DataFrame:
    return first_per_key(
        reviews,
        ["order_id"],
        [F.col("review_answer_timestamp").desc_nulls_last(), F.col("review_id").asc_nulls_last()],
    )


def _order_measures(orders: DataFrame, dim_customers: DataFrame, dim_order_status: DataFrame) -> DataFrame:
    """Everything the fact takes from an order, looked up once per order instead of once per item."""
    keyed = orders.join(dim_customers.select("customer_id", "customer_key"), "customer_id", "left").join(
        dim_order_status, F.col("order_status") == F.col("status_name"), "left"
    )
    carrier = "order_delivered_carrier_date"
    return keyed.select(
        "order_id",
        "customer_key",
        date_key("order_purchase_timestamp").alias("order_date_key"),
        date_key("order_estimated_delivery_date").alias("estimated_delivery_date_key"),
        date_key("order_delivered_customer_date").alias("delivered_date_key"),
        "status_key",
        hours_between("order_approved_at", carrier).alias("processing_time_hours"),
        whole_days_between(carrier, "order_delivered_customer_date").alias("shipping_time_days"),
    )


def build_fct_order_items(
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
    dim_order_status: DataFrame,
    collapse_identical: bool = True,
) -> DataFrame:
    """Order-item fact. ``orders`` holds one row per ``order_id`` (what the clean layer delivers).

    ``collapse_identical=True`` keeps one row for identical units of an order; ``False`` keeps the true item grain.
    Order-level columns depend on ``order_id`` alone, so identical units tie on the sort columns of the key and are
    collapsed by the exchange that numbers the rows; a pass of their own would shuffle all items once more, and hold the
    units of a whole split in a task. Dimensions are expected as written tables, and everything known per order is written before
    the items meet it: the planner then broadcasts what is under its size threshold and sort-merges the rest with hot
    keys split at run time, which it only does for joins that read both sides straight from an exchange.
    """
    keyed = items.join(dim_products.select("product_id", "product_key"), "product_id", "left").join(
        dim_sellers.select("seller_id", "seller_key"), "seller_id", "left"
    )
    unit = ["order_id", "product_key", "seller_key", "price", "freight_value"]
    if collapse_identical:
        units, ties = keyed.select(*unit), []
    else:
        units, ties = keyed.select(*unit, "order_item_id"), ["order_item_id"]
    scores = latest_review_per_order(reviews).select("order_id", "review_score")
    # Full outer: an item takes its review even when its order is missing.
    per_order = materialize(
        _order_measures(orders, dim_customers, dim_order_status).join(scores, "order_id", "full_outer"), "per-order"
    )
    wide = (
        units.join(per_order, "order_id", "left")
        .withColumn("review_score", F.coalesce("review_score", F.lit(DEFAULT_REVIEW_SCORE)))
        .withColumnRenamed("price", "item_price")
    )
    order_by = ["order_id", "customer_key", "product_key", "seller_key", *ties, "item_price", "freight_value"]
    numbered = dense_key(wide, order_by, "order_item_key", unique="collapse" if collapse_identical else False)
    return conform(numbered, "fct_order_items")


def build_fct_marketing_leads(leads: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Won leads: channel and sales cycle, sharing the seller and date dimensions with the sales fact.

    ``leads``: lead_id, seller_id, channel, first_contact_date, won_date.
    """
    keyed = leads.join(dim_sellers.select("seller_id", "seller_key"), "seller_id", "left")
    measured = keyed.select(
        "lead_id",
        "seller_key",
        F.coalesce("channel", F.lit("unknown")).alias("channel"),
        date_key("first_contact_date").alias("first_contact_date_key"),
        date_key("won_date").alias("won_date_key"),
        F.datediff("won_date", "first_contact_date").alias("sales_cycle_days"),
    )
    return conform(dense_key(measured, ["lead_id", "seller_key"], "lead_key"), "fct_marketing_leads")


def role_date(fact: DataFrame, dim_date: DataFrame, fact_key: str, *attributes: str) -> DataFrame:
    """Attach date attributes to a fact in one of its date roles."""
    attrs: list[Column] = [F.col(a) for a in attributes]
    return fact.join(dim_date.select(F.col("date_key").alias(fact_key), *attrs), fact_key, "left")
