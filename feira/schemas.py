"""Table contracts of the three layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGESTED_AT = "ingestion_timestamp"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw table names, their columns (source spelling kept) and key columns.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "orders": _strings(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": _strings(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "order_payments": _strings(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    ),
    "order_reviews": _strings(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
    "customers": _strings(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    ),
    "products": _strings(
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "sellers": _strings("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "geolocation": _strings(
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
    "category_translation": _strings("product_category_name", "product_category_name_english"),
}

LOOKUP_KEYS: dict[str, str] = {
    "orders": "order_id",
    "order_items": "order_id",
    "order_payments": "order_id",
    "order_reviews": "order_id",
    "customers": "customer_id",
    "products": "product_id",
    "sellers": "seller_id",
    "geolocation": "geolocation_zip_code_prefix",
    "category_translation": "product_category_name",
}

# Which raw columns are times, numbers and whole numbers.
TIMESTAMP_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": ("shipping_limit_date",),
    "order_reviews": ("review_creation_date", "review_answer_timestamp"),
}

DOUBLE_COLUMNS: dict[str, tuple[str, ...]] = {
    "order_items": ("price", "freight_value"),
    "order_payments": ("payment_value",),
    "products": ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"),
    "geolocation": ("geolocation_lat", "geolocation_lng"),
}

INTEGER_COLUMNS: dict[str, tuple[str, ...]] = {
    "order_items": ("order_item_id",),
    "order_payments": ("payment_sequential", "payment_installments"),
    "order_reviews": ("review_score",),
    "geolocation": ("geolocation_zip_code_prefix",),
}

# Topic names and the logistics payload.
ORDERS_TOPIC = "ecommerce.orders.live"
LOGISTICS_TOPIC = "ecommerce.logistics.updates"
LOGISTICS_PAYLOAD = _strings(
    "order_id", "customer_id", "delivered_carrier_date", "delivered_customer_date", "estimated_delivery_date"
)

# What a topic reader delivers, and what the archive keeps of it.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
ARCHIVE_SCHEMA = T.StructType(
    [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("kafka_value", T.StringType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField(INGESTED_AT, T.TimestampType()),
    ]
)

# Columns of the curated layer. Surrogate keys are 64-bit, because a dense 32-bit key overflows at two billion rows;
# smart date keys (yyyyMMdd) fit 32 bits.
GOLD_SCHEMAS: dict[str, str] = {
    "dim_customers": (
        "customer_key bigint, customer_id string, customer_unique_id string, "
        "customer_zip_code_prefix string, customer_city string, customer_state string"
    ),
    "dim_sellers": (
        "seller_key bigint, seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "dim_products": (
        "product_key bigint, product_id string, product_category_english string, "
        "product_weight_g double, product_length_cm double, product_volume_cm3 double"
    ),
    "dim_order_status": "status_key bigint, status_name string",
    "dim_date": (
        "date_key int, full_date date, day_of_week string, month_name string, quarter int, year int, "
        "is_holiday_brazil boolean"
    ),
    "fct_order_items": (
        "order_item_key bigint, order_id string, customer_key bigint, product_key bigint, seller_key bigint, "
        "order_date_key int, estimated_delivery_date_key int, delivered_date_key int, status_key bigint, "
        "item_price decimal(10,2), freight_value decimal(10,2), review_score int, "
        "processing_time_hours decimal(10,2), shipping_time_days int"
    ),
    "fct_marketing_leads": (
        "lead_key bigint, lead_id string, seller_key bigint, channel string, first_contact_date_key int, "
        "won_date_key int, sales_cycle_days int"
    ),
}

# Parents of the fact's foreign keys: fact column -> (dimension, its key column).
FACT_FOREIGN_KEYS: dict[str, tuple[str, str]] = {
    "customer_key": ("dim_customers", "customer_key"),
    "product_key": ("dim_products", "product_key"),
    "seller_key": ("dim_sellers", "seller_key"),
    "order_date_key": ("dim_date", "date_key"),
    "estimated_delivery_date_key": ("dim_date", "date_key"),
    "delivered_date_key": ("dim_date", "date_key"),
    "status_key": ("dim_order_status", "status_key"),
}


def fitted(value: Column, data_type: T.DataType | str, what: str) -> Column:
    """``value`` in ``data_type``; a value that does not fit stops the job with a message that names ``what``."""
    cast = value.try_cast(data_type)
    name = data_type if isinstance(data_type, str) else data_type.simpleString()
    wrong = F.raise_error(F.concat(F.lit(f"{what}: does not fit {name}: "), value.cast("string"))).cast(data_type)
    return F.when(value.isNotNull() & cast.isNull(), wrong).otherwise(cast)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast ``df`` to the declared curated schema; a value that does not fit fails the build."""
    given = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        same = given.get(field.name) == field.dataType
        return F.col(field.name) if same else fitted(F.col(field.name), field.dataType, f"{table}.{field.name}")

    schema = T.StructType.fromDDL(GOLD_SCHEMAS[table])
    return df.select(*[column(f).alias(f.name) for f in schema.fields])
