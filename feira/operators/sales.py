"""Sales questions on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.functions.dates import month_of_key
from feira.operators.groups import share_of_total
from feira.operators.star import role_date
from feira.schemas import fitted


def category_funnel(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Orders and revenue per category, with the revenue share."""
    items = fact.join(dim_products.select("product_key", "product_category_english"), "product_key", "left")
    per_order = items.groupBy("product_category_english", "order_id").agg(F.sum("item_price").alias("revenue"))
    per_category = per_order.groupBy("product_category_english").agg(
        F.count("*").alias("orders"), F.sum("revenue").alias("revenue")
    )
    return share_of_total(per_category, {"revenue": "revenue_share"})


def category_rank(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Rank of every category by revenue within its month. Summed per product before meeting the dimension."""
    per_product = fact.groupBy("product_key", month_of_key("order_date_key").alias("month")).agg(
        F.sum("item_price").alias("revenue")
    )
    per_category = (
        per_product.join(dim_products.select("product_key", "product_category_english"), "product_key", "left")
        .groupBy("month", "product_category_english")
        .agg(F.sum("revenue").alias("revenue"))
    )
    by_revenue = W.partitionBy("month").orderBy(F.desc("revenue"))
    return per_category.withColumn("revenue_rank", F.rank().over(by_revenue))


def average_order_value(fact: DataFrame, dim_order_status: DataFrame, status: str = "delivered") -> DataFrame:
    """Revenue of one status per fact row and per order."""
    chosen = fact.join(dim_order_status.filter(F.col("status_name") == status), "status_key", "left_semi")
    per_order = chosen.groupBy("order_id").agg(F.count("*").alias("items"), F.sum("item_price").alias("revenue"))
    revenue = F.sum("revenue").cast("double")
    return per_order.agg(
        F.sum("items").alias("items"),
        F.count("*").alias("orders"),
        F.try_divide(revenue, F.sum("items")).alias("value_per_item_row"),
        F.try_divide(revenue, F.count("*")).alias("value_per_order"),
    )


def payment_mix(payments: DataFrame) -> DataFrame:
    """Share of payments and of money by payment type, and the average number of instalments."""
    per_type = payments.groupBy("payment_type").agg(
        F.count("*").alias("payments"),
        F.sum(fitted(F.col("payment_value"), "decimal(18,2)", "payment_value")).alias("payment_value"),
        F.avg("payment_installments").alias("avg_installments"),
    )
    return share_of_total(per_type, {"payments": "payment_share", "payment_value": "value_share"})


def state_share(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Buying customers and revenue per customer state."""
    per_customer = fact.groupBy("customer_key").agg(F.sum("item_price").alias("revenue"))
    per_state = (
        per_customer.join(dim_customers.select("customer_key", "customer_state"), "customer_key", "left")
        .groupBy("customer_state")
        .agg(F.count("customer_key").alias("customers"), F.sum("revenue").alias("revenue"))
    )
    return share_of_total(per_state, {"revenue": "revenue_share"})


def monthly_trend(fact: DataFrame) -> DataFrame:
    """Revenue per month with year-to-date total and change against the calendar month before.

    The month before is found by an equi-join on a running month number, so months without sales leave a gap
    instead of shifting the comparison, and no window spans the whole table. Revenue without a date is a row without a
    month, of no year and with no month before.
    """
    month = F.col("month")
    monthly = (
        fact.groupBy(month_of_key("order_date_key").alias("month"))
        .agg(F.sum("item_price").alias("revenue"))
        .withColumn("year", F.floor(month / 100).cast("int"))
        .withColumn("month_number", F.col("year") * 12 + month % 100)
    )
    before = monthly.select(
        (F.col("month_number") + 1).alias("month_number"), F.col("revenue").alias("previous_revenue")
    )
    to_date = W.partitionBy("year").orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    change = F.col("revenue") - F.col("previous_revenue")
    return monthly.join(before, "month_number", "left").select(
        "month",
        "revenue",
        F.sum("revenue").over(to_date).alias("revenue_ytd"),
        "previous_revenue",
        change.alias("revenue_change"),
        F.try_divide(change.cast("double"), F.col("previous_revenue").cast("double")).alias("change_rate"),
    )


def date_subtotals(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue for year > quarter > month with subtotals; rolled up from daily sums, not from items."""
    daily = fact.groupBy("order_date_key").agg(F.count("*").alias("items"), F.sum("item_price").alias("revenue"))
    dated = role_date(daily, dim_date, "order_date_key", "year", "quarter").withColumn(
        "month", month_of_key("order_date_key") % 100
    )
    return _rollup(dated, "year", "quarter", "month")


def place_subtotals(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Revenue for state > city with subtotals; rolled up from per-customer sums."""
    per_customer = fact.groupBy("customer_key").agg(
        F.count("*").alias("items"), F.sum("item_price").alias("revenue")
    )
    placed = per_customer.join(
        dim_customers.select("customer_key", "customer_state", "customer_city"), "customer_key", "left"
    )
    return _rollup(placed, "customer_state", "customer_city")


def _rollup(df: DataFrame, *levels: str) -> DataFrame:
    finest = df.groupBy(*levels).agg(F.sum("items").alias("items"), F.sum("revenue").alias("revenue"))
    return finest.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("items").alias("items"),
        F.sum("revenue").alias("revenue"),
    )


def one_time_buyers(orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Per calendar year: buyers, buyers with a single order, and their ratio."""
    per_account = orders.groupBy("customer_id", F.year("order_purchase_timestamp").alias("order_year")).agg(
        F.count("*").alias("orders")
    )
    per_person = (
        per_account.join(dim_customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
        # An account that no customer row knows is a person of its own.
        .groupBy(F.coalesce("customer_unique_id", F.concat(F.lit("unknown "), "customer_id")), "order_year")
        .agg(F.sum("orders").alias("orders"))
    )
    once = F.count_if(F.col("orders") == 1)
    return per_person.groupBy("order_year").agg(
        F.count("*").alias("buyers"),
        once.alias("one_time_buyers"),
        F.try_divide(once, F.count("*")).alias("one_time_ratio"),
    )


def channel_sellers(
    fact: DataFrame, leads: DataFrame, dim_sellers: DataFrame, year: int, quarter: int
) -> DataFrame:
    """Drill-across: what sellers won by each channel sold in a quarter, and how fast they handed over.

    Each fact is aggregated to the shared seller dimension first, then the two results are joined. What a seller sold
    is attributed once, to the channel that won it first (``is_first_channel``). The quarter is a range of date keys,
    so it reaches the scan of the fact.
    """
    first_month = 3 * quarter - 2
    in_quarter = F.col("order_date_key").between(
        year * 10000 + first_month * 100 + 1, year * 10000 + (first_month + 2) * 100 + 31
    )
    sales = (
        fact.filter(in_quarter)
        .groupBy("seller_key")
        .agg(
            F.sum("item_price").alias("revenue"),
            F.try_divide(F.sum("processing_time_hours").cast("double"), F.count("processing_time_hours")).alias(
                "avg_processing_hours"
            ),
        )
    )
    won = leads.groupBy("seller_key", "channel").agg(
        F.count("*").alias("leads"),
        F.avg("sales_cycle_days").alias("avg_sales_cycle_days"),
        F.min(F.struct("won_date_key", "lead_id")).alias("first_won"),
    )
    first = won.groupBy("seller_key").agg(F.min_by("channel", "first_won").alias("first_channel"))
    credited = (
        sales.join(first, "seller_key", "left")
        .select("seller_key", F.col("first_channel").alias("channel"), "revenue", "avg_processing_hours")
        .filter("channel is not null")
    )
    return (
        won.join(credited, ["seller_key", "channel"], "left")
        .join(first, "seller_key", "left")
        .join(dim_sellers.select("seller_key", "seller_id"), "seller_key", "left")
        .select(
            "channel",
            "seller_id",
            "leads",
            "avg_sales_cycle_days",
            (F.col("channel") == F.col("first_channel")).alias("is_first_channel"),
            "revenue",
            "avg_processing_hours",
        )
    )
