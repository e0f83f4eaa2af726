"""Hot keys with broadcast switched off: joins must be split, results must stay whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feira.operators import clean, star
from feira.operators.keys import dense_key, global_rank

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "16",
}
ROWS = 60_000


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(name):
    """A third of the rows share one value, the others are spread over 5,000."""
    spread = F.concat(F.lit(name), (F.col("id") % 5000).cast("string"))
    return F.when(F.col("id") % 3 == 0, F.lit(f"{name}hot")).otherwise(spread)


def orders(spark):
    base = F.lit("2018-01-01 00:00:00").cast("timestamp")
    carrier = base + F.make_dt_interval((F.col("id") % 300).cast("int"))
    delivered = F.when(F.col("id") % 10 > 0, carrier + F.make_dt_interval((F.col("id") % 7).cast("int")))
    return spark.range(0, ROWS, 1, 8).select(
        F.col("id").cast("string").alias("order_id"),
        hot("c").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        base.alias("order_purchase_timestamp"),
        base.alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        base.alias("order_estimated_delivery_date"),
    )


def customers(spark):
    names = spark.range(5000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id"))
    names = names.union(spark.createDataFrame([("chot",)], "customer_id string"))
    return names.select(
        "customer_id",
        F.col("customer_id").alias("customer_unique_id"),
        F.when(F.col("customer_id") == "chot", "hot").otherwise(F.substring("customer_id", -2, 2)).alias(
            "customer_zip_code_prefix"
        ),
        F.lit("x").alias("customer_city"),
        F.lit("SP").alias("customer_state"),
    )


def test_imputation_splits_a_hot_customer_and_a_hot_zip(skewed):
    by_customer = clean._with_delivery_days(orders(skewed), customers(skewed))
    assert "skew=true" in final_plan(by_customer)
    result = clean.impute_delivery(orders(skewed), customers(skewed))
    assert "skew=true" in final_plan(result)
    assert result.count() == ROWS
    filled = result.filter("order_id = '60'").first()["order_delivered_customer_date"]
    assert filled == dt.datetime(2018, 1, 1) + dt.timedelta(days=60 % 300 + 3)


def test_fact_splits_hot_products_sellers_and_orders(skewed, monkeypatch):
    spark = skewed
    items = spark.range(0, ROWS, 1, 8).select(
        hot("o").alias("order_id"),
        F.lit(1).alias("order_item_id"),
        hot("p").alias("product_id"),
        hot("s").alias("seller_id"),
        F.col("id").cast("double").alias("price"),
        F.lit(1.0).alias("freight_value"),
    )

    def keys(name, key):
        spread = spark.range(5000).select(
            (F.col("id") + 2).alias(key), F.concat(F.lit(name), F.col("id").cast("string")).alias(f"{key[:-4]}_id")
        )
        return spread.unionByName(spark.createDataFrame([(1, f"{name}hot")], f"{key} bigint, {key[:-4]}_id string"))

    empty = [f for f in orders(spark).schema.fields if f.name != "order_id"]
    every_order = keys("o", "order_key").select(
        "order_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in empty]
    )
    reviews = every_order.select(
        "order_id",
        F.lit("r").alias("review_id"),
        F.lit(4).alias("review_score"),
        F.lit(None).cast("timestamp").alias("review_answer_timestamp"),
    )
    status = spark.createDataFrame([(1, "delivered")], "status_key bigint, status_name string")
    ranked = []

    def watched(df, order_by, key, unique):
        ranked.append(df)
        return dense_key(df, order_by, key, unique)

    monkeypatch.setattr(star, "dense_key", watched)
    fact = star.build_fct_order_items(
        items, every_order, reviews, keys("c", "customer_key"), keys("p", "product_key"), keys("s", "seller_key"), status
    )
    assert final_plan(ranked[0]).count("skew=true") >= 3
    totals = fact.agg(
        F.count("*"), F.count("product_key"), F.count("seller_key"), F.min("review_score"), F.max("order_item_key")
    ).first()
    assert tuple(totals) == (ROWS, ROWS, ROWS, 4, ROWS)


def test_copies_are_spread_over_slices(spark):
    copies = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("k")
    )
    ranked = global_rank(copies, ["k"], "rank")
    got = ranked.df.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first()
    assert tuple(got) == (30_000, 1, 30_000)
    of_copies = ranked.df.filter("k = 'copy'").agg(F.count("*"), F.max("rank") - F.min("rank") + 1).first()
    assert tuple(of_copies) == (10_000, 10_000)
