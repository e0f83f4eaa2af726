"""Delivery questions on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.casts import to_int
from feira.functions.dates import date_of_key
from feira.functions.geo import haversine_km
from feira.operators.groups import discrete_quantile


def delay_days() -> Column:
    """Days a delivery came after its estimate (negative when early)."""
    return F.datediff(date_of_key("delivered_date_key"), date_of_key("estimated_delivery_date_key"))


def is_late() -> Column:
    return F.col("delivered_date_key") > F.col("estimated_delivery_date_key")


def on_time_orders(orders: DataFrame, imputed_col: str | None = None) -> DataFrame:
    """Delivered and late orders per year of purchase, one count per order; without filled-in dates if
    ``imputed_col`` flags them."""
    day = F.to_date("order_delivered_customer_date")
    real = F.lit(True) if imputed_col is None else ~F.coalesce(F.col(imputed_col), F.lit(False))
    delivered = F.count_if(day.isNotNull() & real)
    late = F.count_if((day > F.to_date("order_estimated_delivery_date")) & real)
    return orders.groupBy(F.year("order_purchase_timestamp").alias("order_year")).agg(
        delivered.alias("delivered_orders"),
        late.alias("late_orders"),
        F.try_divide(delivered - late, delivered).alias("on_time_rate"),
    )


def on_time_rate(fact: DataFrame) -> DataFrame:
    """Delivered and late fact rows per year of purchase; rows without a delivery are left out of the rate."""
    delivered, late = F.count("delivered_date_key"), F.count_if(is_late())
    return fact.groupBy(F.floor(F.col("order_date_key") / 10000).cast("int").alias("order_year")).agg(
        delivered.alias("delivered_items"),
        late.alias("late_items"),
        F.try_divide(delivered - late, delivered).alias("on_time_rate"),
    )


def seller_processing(fact: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Hand-over hours per seller: mean and exact lower median."""
    hours = fact.filter(F.col("processing_time_hours").isNotNull())
    means = hours.groupBy("seller_key").agg(
        F.count("*").alias("items"),
        (F.sum("processing_time_hours").cast("double") / F.count("*")).alias("avg_hours"),
    )
    medians = discrete_quantile(hours, ["seller_key"], "processing_time_hours", "median_hours")
    # Rows without a seller form one group of their own.
    medians = medians.withColumnRenamed("seller_key", "of_seller")
    return (
        means.join(medians, F.col("seller_key").eqNullSafe(F.col("of_seller")))
        .join(dim_sellers.select("seller_key", "seller_id"), "seller_key", "left")
        .select("seller_id", "items", "avg_hours", F.col("median_hours").cast("double").alias("median_hours"))
    )


def lane_shipping(fact: DataFrame, dim_sellers: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Transit days per seller state and customer state."""
    lanes = fact.join(dim_sellers.select("seller_key", "seller_state"), "seller_key", "left").join(
        dim_customers.select("customer_key", "customer_state"), "customer_key", "left"
    )
    return lanes.groupBy("seller_state", "customer_state").agg(
        F.count("*").alias("items"), F.avg("shipping_time_days").alias("avg_shipping_days")
    )


def zip_coordinates(geolocation: DataFrame) -> DataFrame:
    """Mean coordinate per zip prefix."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip")).agg(
        F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng")
    )


def geo_grid(
    fact: DataFrame, dim: DataFrame, geolocation: DataFrame, digits: int = 1, party: str = "customer"
) -> DataFrame:
    """Buying customers (or selling ``party="seller"``) and sold items per grid cell of their coordinate; summed per
    zip before the lookup. Parties without a known zip or coordinate form the cell with NULL coordinates."""
    key = f"{party}_key"
    per_party = fact.groupBy(key).agg(F.count("*").alias("items"))
    zips = dim.select(key, to_int(f"{party}_zip_code_prefix").alias("zip"))
    per_zip = (
        per_party.join(zips, key, "left")
        .groupBy("zip")
        .agg(F.count(key).alias(f"{party}s"), F.sum("items").alias("items"))
    )
    return (
        per_zip.join(zip_coordinates(geolocation), "zip", "left")
        .groupBy(F.round("lat", digits).alias("cell_lat"), F.round("lng", digits).alias("cell_lng"))
        .agg(F.sum(f"{party}s").alias(f"{party}s"), F.sum("items").alias("items"))
    )


def lane_distance(
    fact: DataFrame, dim_sellers: DataFrame, dim_customers: DataFrame, geolocation: DataFrame
) -> DataFrame:
    """Items and great-circle kilometres per pair of seller zip and customer zip that trade (NULL: not known).

    With very many zips that trade this tends to all their pairs; ``state_lane_distance`` stays small.
    """
    lanes = (
        fact.join(
            dim_sellers.select("seller_key", to_int("seller_zip_code_prefix").alias("seller_zip")), "seller_key", "left"
        )
        .join(
            dim_customers.select("customer_key", to_int("customer_zip_code_prefix").alias("customer_zip")),
            "customer_key",
            "left",
        )
        .groupBy("seller_zip", "customer_zip")
        .agg(F.count("*").alias("items"))
    )
    coords = zip_coordinates(geolocation)
    origin = coords.select(F.col("zip").alias("seller_zip"), F.col("lat").alias("lat1"), F.col("lng").alias("lng1"))
    target = coords.select(F.col("zip").alias("customer_zip"), F.col("lat").alias("lat2"), F.col("lng").alias("lng2"))
    distance = haversine_km(F.col("lat1"), F.col("lng1"), F.col("lat2"), F.col("lng2"))
    return (
        lanes.join(origin, "seller_zip", "left")
        .join(target, "customer_zip", "left")
        .select("seller_zip", "customer_zip", "items", distance.alias("distance_km"))
    )


def state_lane_distance(
    fact: DataFrame, dim_sellers: DataFrame, dim_customers: DataFrame, geolocation: DataFrame, band_km: int = 500
) -> DataFrame:
    """Items per seller state, customer state and distance band (its lower edge; NULL: not known)."""
    states = [
        dim.select(to_int(f"{party}_zip_code_prefix").alias(f"{party}_zip"), f"{party}_state")
        .groupBy(f"{party}_zip")
        .agg(F.min(f"{party}_state").alias(f"{party}_state"))
        for party, dim in (("seller", dim_sellers), ("customer", dim_customers))
    ]
    lanes = lane_distance(fact, dim_sellers, dim_customers, geolocation)
    placed = lanes.join(states[0], "seller_zip", "left").join(states[1], "customer_zip", "left")
    band = (F.floor(F.col("distance_km") / band_km) * band_km).cast("bigint").alias("from_km")
    return placed.groupBy("seller_state", "customer_state", band).agg(F.sum("items").alias("items"))
