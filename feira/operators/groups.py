"""Per-group building blocks that stay whole and stay balanced when one group holds a third of the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """One row per key, the first in ``order_by`` order.

    ``row_number = 1`` is planned with a partial group limit before the exchange, so each task sends at most one row
    per key however hot the key is.
    """
    rank = "__rank"
    return (
        df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)))
        .filter(F.col(rank) == 1)
        .drop(rank)
    )


def any_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; the survivor is the smallest by the other columns, so reruns agree."""
    others = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return first_per_key(df, keys, others or [F.col(keys[0])])


def discrete_quantile(
    df: DataFrame, keys: list[str], value_col: str, result_col: str, numerator: int = 1, denominator: int = 2
) -> DataFrame:
    """Exact discrete quantile per group: the value at place ``ceil(n * numerator / denominator)``.

    Rows are first counted per (group, value), combined on the map side, so the window runs over the distinct values
    of a group rather than over its rows. With the default this is the lower median. NULL values are left out.
    """
    places = W.partitionBy(*keys).orderBy(value_col).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = df.filter(F.col(value_col).isNotNull()).groupBy(*keys, value_col).agg(F.count("*").alias("__n"))
    upto = counted.withColumn("__upto", F.sum("__n").over(places)).withColumn(
        "__total", F.sum("__n").over(W.partitionBy(*keys))
    )
    # First value whose cumulative count reaches the wanted place: upto*den >= total*num, previous one does not.
    reached = F.col("__upto") * denominator >= F.col("__total") * numerator
    before = (F.col("__upto") - F.col("__n")) * denominator < F.col("__total") * numerator
    return upto.filter(reached & before).select(*keys, F.col(value_col).alias(result_col))


def share_of_total(df: DataFrame, shares: Mapping[str, str]) -> DataFrame:
    """Each row's share of its column total, NULL when the total is zero; ``shares`` maps value to share columns.

    ``df`` is an aggregate; its totals are scalar subqueries that reuse the aggregate's own exchange.
    """
    totals = {value: df.agg(F.sum(value).cast("double").alias("total")).scalar() for value in shares}
    return df.withColumns(
        {share: F.try_divide(F.col(value).cast("double"), totals[value]) for value, share in shares.items()}
    )
