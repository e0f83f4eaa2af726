"""Data-quality constraints per table and gates per layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira import schemas

RESULT_SCHEMA = (
    "layer string, table_name string, constraint_name string, metric double, constraint_status string, message string"
)


class DataQualityError(RuntimeError):
    """At least one constraint of a layer failed."""


@dataclass(frozen=True)
class Complete:
    """No NULLs in the column."""

    column: str

    @property
    def name(self) -> str:
        return f"complete({self.column})"


@dataclass(frozen=True)
class Unique:
    """Every non-NULL value occurs once."""

    column: str

    @property
    def name(self) -> str:
        return f"unique({self.column})"


@dataclass(frozen=True)
class Satisfies:
    """A SQL predicate holds on every row; NULL counts as a miss."""

    predicate: str

    @property
    def name(self) -> str:
        return f"satisfies({self.predicate})"


@dataclass(frozen=True)
class MaxLength:
    """No text longer than ``length``."""

    column: str
    length: int

    @property
    def name(self) -> str:
        return f"max_length({self.column},{self.length})"


Constraint = Complete | Unique | Satisfies | MaxLength

# The constraints of each layer.
RAW_SUITE: Mapping[str, tuple[Constraint, ...]] = {
    "orders": (Complete("order_id"), Unique("order_id"), Complete("customer_id")),
    "customers": (Complete("customer_id"),),
    "products": (Complete("product_id"),),
}

CLEAN_SUITE: Mapping[str, tuple[Constraint, ...]] = {
    "orders": (Complete("order_id"), Unique("order_id"), Complete("customer_id")),
    "order_reviews": (
        Complete("review_id"),
        Satisfies("review_score >= 1 AND review_score <= 5"),
    ),
    "order_items": (Complete("order_id"), Satisfies("price >= 0")),
}

GOLD_SUITE: Mapping[str, tuple[Constraint, ...]] = {
    "fct_order_items": (
        Complete("order_item_key"),
        Unique("order_item_key"),
        Complete("customer_key"),
        Complete("product_key"),
        Satisfies("item_price >= 0"),
        Satisfies("freight_value >= 0"),
    ),
    "dim_customers": (Complete("customer_key"), Unique("customer_key")),
}

# Natural keys and text widths the relational copy of the curated layer relies on.
RELATIONAL_SUITE: Mapping[str, tuple[Constraint, ...]] = {
    "dim_customers": (
        Complete("customer_id"),
        Unique("customer_id"),
        MaxLength("customer_id", 50),
        MaxLength("customer_unique_id", 50),
        MaxLength("customer_city", 100),
        MaxLength("customer_state", 2),
    ),
    "dim_sellers": (
        Complete("seller_id"),
        Unique("seller_id"),
        MaxLength("seller_id", 50),
        MaxLength("seller_city", 100),
        MaxLength("seller_state", 2),
    ),
    "dim_products": (
        Complete("product_id"),
        Unique("product_id"),
        MaxLength("product_id", 50),
        MaxLength("product_category_english", 100),
    ),
    "dim_order_status": (Complete("status_name"), Unique("status_name"), MaxLength("status_name", 20)),
    "dim_date": (
        Complete("full_date"),
        Unique("date_key"),
        MaxLength("day_of_week", 10),
        MaxLength("month_name", 10),
    ),
    "fct_order_items": (Complete("order_id"), MaxLength("order_id", 50)),
}


def _row_metric(constraint: Constraint) -> Column:
    """Share of rows that meet a per-row constraint; NULL on an empty table."""
    if isinstance(constraint, Complete):
        met = F.col(constraint.column).isNotNull()
    elif isinstance(constraint, Satisfies):
        met = F.coalesce(F.expr(constraint.predicate), F.lit(False))
    else:
        met = F.coalesce(F.char_length(constraint.column) <= constraint.length, F.lit(True))
    return F.try_divide(F.count_if(met), F.count("*"))


def _unique_metric(df: DataFrame, constraint: Unique) -> DataFrame:
    """Share of non-NULL values' rows whose value occurs once; counted per value, combined on the map side."""
    counts = df.filter(F.col(constraint.column).isNotNull()).groupBy(constraint.column).agg(F.count("*").alias("n"))
    return counts.agg(F.try_divide(F.count_if(F.col("n") == 1), F.sum("n")).alias("metric")).select(
        F.lit(constraint.name).alias("constraint_name"), "metric"
    )


def check_table(df: DataFrame, layer: str, table: str, constraints: tuple[Constraint, ...]) -> DataFrame:
    """One row per constraint. All per-row constraints share one aggregate pass over the table."""
    per_row = [c for c in constraints if not isinstance(c, Unique)]
    parts = []
    if per_row:
        metrics = df.agg(*[_row_metric(c).alias(f"m{i}") for i, c in enumerate(per_row)])
        pairs = [
            F.struct(F.lit(c.name).alias("constraint_name"), F.col(f"m{i}").alias("metric"))
            for i, c in enumerate(per_row)
        ]
        parts.append(metrics.select(F.inline(F.array(*pairs))))
    parts += [_unique_metric(df, c) for c in constraints if isinstance(c, Unique)]
    measured = reduce(DataFrame.unionByName, parts)
    # A table without rows has no metric and meets nothing.
    passed = F.coalesce(F.col("metric") == 1.0, F.lit(False))
    return measured.select(
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        "constraint_name",
        "metric",
        F.when(passed, "Success").otherwise("Failure").alias("constraint_status"),
        F.when(F.col("metric").isNull(), "no rows to check")
        .when(~passed, F.format_string("value %s does not meet the constraint", F.col("metric")))
        .alias("message"),
    )


def check_layer(
    spark: SparkSession,
    layer: str,
    suite: Mapping[str, tuple[Constraint, ...]],
    read: Callable[[str], DataFrame | None],
) -> DataFrame:
    """Results of a whole suite. A table that ``read`` does not find is reported as ``Skipped``."""
    parts = []
    for table, constraints in suite.items():
        df = read(table)
        if df is None:
            parts.append(
                spark.createDataFrame(
                    [(layer, table, "table present", None, "Skipped", "table not found")], RESULT_SCHEMA
                )
            )
        else:
            parts.append(check_table(df, layer, table, constraints))
    return reduce(DataFrame.unionByName, parts)


def gate(results: DataFrame, strict: bool = True) -> list:
    """Raise after all checks have run if any failed (or, when strict, was skipped); else return the result rows.

    The rows are one per declared constraint, whatever the size of the data.
    """
    rows = results.collect()
    bad = ("Failure", "Skipped") if strict else ("Failure",)
    failed = [r for r in rows if r["constraint_status"] in bad]
    if failed:
        listing = "; ".join(
            f"{r['layer']}.{r['table_name']}: {r['constraint_name']} {r['constraint_status']}" for r in failed
        )
        raise DataQualityError(f"{len(failed)} constraint(s) not met: {listing}")
    return rows


def failed_count(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("constraint_status") == "Failure").alias("failed"))


def foreign_key_violations(
    fact: DataFrame,
    dimensions: Mapping[str, DataFrame],
    foreign_keys: Mapping[str, tuple[str, str]] = schemas.FACT_FOREIGN_KEYS,
) -> DataFrame:
    """Per foreign key: non-NULL fact rows, rows without a parent, and NULLs.

    The fact is read once: its keys are unpivoted and counted per value before any exchange, so a hot key travels as
    a handful of counters, and only distinct values meet the dimensions.
    """
    names = list(foreign_keys)
    pairs = [F.struct(F.lit(n).alias("foreign_key"), F.col(n).cast("bigint").alias("value")) for n in names]
    counted = fact.select(F.inline(F.array(*pairs))).groupBy("foreign_key", "value").agg(F.count("*").alias("n"))
    parents = {}
    for name, parent in foreign_keys.items():
        parents.setdefault(parent, []).append(name)
    known = reduce(
        DataFrame.unionByName,
        [
            dimensions[dim].select(
                F.explode(F.array(*[F.lit(n) for n in children])).alias("foreign_key"),
                F.col(column).cast("bigint").alias("value"),
                F.lit(True).alias("known"),
            )
            for (dim, column), children in parents.items()
        ],
    )
    matched = counted.join(known, ["foreign_key", "value"], "left")
    is_null = F.col("value").isNull()
    return matched.groupBy("foreign_key").agg(
        F.sum(F.when(~is_null, F.col("n")).otherwise(0)).alias("checked_rows"),
        F.sum(F.when(~is_null & F.col("known").isNull(), F.col("n")).otherwise(0)).alias("orphan_rows"),
        F.sum(F.when(is_null, F.col("n")).otherwise(0)).alias("null_rows"),
    )
