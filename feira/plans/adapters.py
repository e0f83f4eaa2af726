"""The driver's tables dressed as the raw retail tables (rules in FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira import schemas
from feira.session import configure
from feira.sources.readers import as_raw


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def _key(col: Column | str) -> Column:
    return F.lpad((F.col(col) if isinstance(col, str) else col).cast("string"), 10, "0")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    purchase = F.col("o_orderdate") + _hours(k % 24)
    carrier = F.when(k % 89 != 0, purchase + _hours(k % 72 + 12))
    columns = {
        "order_id": _key(k),
        "customer_id": _key("o_custkey"),
        "order_status": F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "canceled"),
        "order_purchase_timestamp": _text(purchase),
        "order_approved_at": F.when(k % 97 != 0, _text(purchase + _hours(k % 48))),
        "order_delivered_carrier_date": _text(carrier),
        "order_delivered_customer_date": F.when(k % 11 != 0, _text(carrier + _hours(24 + k % 331))),
        "order_estimated_delivery_date": _text(F.date_trunc("day", purchase) + _days(8 + k % 13)),
    }
    return load(spark, sf_dir, "orders").select(*[c.alias(n) for n, c in columns.items()])


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _placed(spark, sf_dir, load(spark, sf_dir, "customer"), "c_nationkey")
    return placed.select(
        _key("c_custkey").alias("customer_id"),
        _key("c_custkey").alias("customer_unique_id"),
        F.col("zip").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _placed(spark, sf_dir, load(spark, sf_dir, "supplier"), "s_nationkey")
    return placed.select(
        _key("s_suppkey").alias("seller_id"),
        F.col("zip").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def _placed(spark: SparkSession, sf_dir: str, df: DataFrame, nation_col: str) -> DataFrame:
    """City and state from nation and region (25 and 5 rows at every scale)."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name", F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("zip")
    )
    return df.join(places, F.col(nation_col) == F.col("n_nationkey"))


def raw_order_items(spark: SparkSession, sf_dir: str, with_repeats: bool = False) -> DataFrame:
    """``with_repeats`` adds a second identical unit to every order whose key divides by 19."""
    items = load(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber")
    if with_repeats:
        repeated = F.when(F.col("l_orderkey") % 19 == 0, F.array(number, number + 100)).otherwise(F.array(number))
        items = items.withColumn("l_linenumber", F.explode(repeated))
    return as_raw(
        items.select(
            _key("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            _key("l_partkey").alias("product_id"),
            _key("l_suppkey").alias("seller_id"),
            _text(F.col("l_shipdate")).alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_quantity") * 0.25 + 5).alias("freight_value"),
        ),
        schemas.RAW_SCHEMAS["order_items"],
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    return as_raw(
        load(spark, sf_dir, "part").select(
            _key(k).alias("product_id"),
            F.when(k % 41 != 0, F.lower("p_type")).alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length("p_type").alias("product_description_lenght"),
            F.lit(1).alias("product_photos_qty"),
            (size * 100).alias("product_weight_g"),
            size.alias("product_length_cm"),
            (size % 7 + 1).alias("product_height_cm"),
            F.when(k % 53 != 0, size % 5 + 2).alias("product_width_cm"),
        ),
        schemas.RAW_SCHEMAS["products"],
    )


# Translations for four of the six categories; the others fall back to their own name.
TRANSLATIONS = {"economy": "budget", "standard": "regular", "promo": "promotion", "small": "compact"}


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per translated category that occurs."""
    name = F.lower("p_type")
    english = F.create_map(*[F.lit(x) for pair in TRANSLATIONS.items() for x in pair])[name]
    return (
        load(spark, sf_dir, "part")
        .select(name.alias("product_category_name"), english.alias("product_category_name_english"))
        .filter(F.col("product_category_name_english").isNotNull())
        .distinct()
    )


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    kinds = F.array(*[F.lit(t) for t in ("credit_card", "boleto", "voucher", "debit_card")])
    return as_raw(
        load(spark, sf_dir, "orders").select(
            _key(k).alias("order_id"),
            F.lit(1).alias("payment_sequential"),
            kinds[(k % 4).cast("int")].alias("payment_type"),
            (1 + k % 10).alias("payment_installments"),
            F.col("o_totalprice").alias("payment_value"),
        ),
        schemas.RAW_SCHEMAS["order_payments"],
    )


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    epoch = F.lit("2018-01-01 00:00:00").cast("timestamp_ntz")
    scored = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return as_raw(
        scored.select(
            _key(k).alias("review_id"),
            _key(F.floor(k / 2)).alias("order_id"),
            (1 + 2 * F.col("quality") + 2 * (1 - F.col("toxic"))).alias("review_score"),
            F.lit(None).alias("review_comment_title"),
            F.when(k % 17 != 0, F.col("text")).alias("review_comment_message"),
            _text(epoch + _hours(k % 1000)).alias("review_creation_date"),
            F.when(k % 29 != 0, _text(epoch + _hours(k * 37 % 1000))).alias("review_answer_timestamp"),
        ),
        schemas.RAW_SCHEMAS["order_reviews"],
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return as_raw(
        load(spark, sf_dir, "nation")
        .join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.lpad(k.cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
            (k - 30).cast("double").alias("geolocation_lat"),
            (k * 0.5 - 60).cast("double").alias("geolocation_lng"),
            F.col("n_name").alias("geolocation_city"),
            F.col("r_name").alias("geolocation_state"),
        ),
        schemas.RAW_SCHEMAS["geolocation"],
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every raw table but the orders, which are split first."""
    return {
        "customers": raw_customers(spark, sf_dir),
        "geolocation": raw_geolocation(spark, sf_dir),
        "order_items": raw_order_items(spark, sf_dir),
        "order_payments": raw_order_payments(spark, sf_dir),
        "order_reviews": raw_order_reviews(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "sellers": raw_sellers(spark, sf_dir),
        "category_translation": raw_category_translation(spark, sf_dir),
    }


def event_topic(events: DataFrame) -> DataFrame:
    """Events as topic rows; works on a batch and on a stream."""
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def as_topic(messages: DataFrame, offset: Column, timestamp: Column) -> DataFrame:
    """Keyed messages as topic rows; a key always lands in the same partition."""
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        (F.col("key").cast("bigint") % 4).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def marketing_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    channels = F.array(*[F.lit(c) for c in ("organic_search", "paid_search", "social", "email")])
    first = F.date_add(F.lit("2000-01-01").cast("date"), (k % 300).cast("int"))
    return load(spark, sf_dir, "supplier").select(
        _key(k).alias("lead_id"),
        _key(k).alias("seller_id"),
        channels[(k % 4).cast("int")].alias("channel"),
        first.alias("first_contact_date"),
        F.date_add(first, (k % 60).cast("int")).alias("won_date"),
    )
