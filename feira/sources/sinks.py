"""Writers: relational copies, CSV exports, JSON messages and row counts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira import schemas


def written_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Rows of a written Parquet table, taken from the file footers: no column is read and the plan behind the write
    is not run again. (An ``Observation`` would do as well, but a session that has used one can no longer ship
    ``pyspark.ml`` models with a training summary to its executors.)"""
    return spark.read.schema(schema).parquet(path).count()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    truncate: bool = False,
    connections: int = 16,
) -> None:
    """Overwrite a relational table; ``truncate`` keeps the table's own column types and keys. ``connections`` bounds
    how many tasks write at once."""
    df.write.options(truncate=truncate, numPartitions=connections, batchsize=10_000).jdbc(
        url, table, mode="overwrite", properties=dict(properties or {})
    )


# Facts refer to dimensions, so they go first when dropping and last when loading.
FACT_TABLES = ("fct_order_items", "fct_marketing_leads")


def relational_load_order(tables: Iterable[str]) -> list[tuple[str, str]]:
    """Steps of a relational reload: drop dependent facts, load dimensions, load facts."""
    names = list(tables)
    facts = [t for t in names if t in FACT_TABLES]
    dims = [t for t in names if t not in FACT_TABLES]
    return [("drop", t) for t in facts] + [("load", t) for t in (*dims, *facts)]


def load_relational(
    tables: Mapping[str, DataFrame],
    url: str,
    drop_table: Callable[[str], None],
    properties: Mapping[str, str] | None = None,
) -> None:
    """Reload a star schema into a database. ``drop_table`` runs the database's own drop statement."""
    for step, table in relational_load_order(tables):
        if step == "drop":
            drop_table(table)
        else:
            write_jdbc(tables[table], url, table, properties)


def export_csv(df: DataFrame, path: str) -> None:
    """Header CSV; blanks at the ends of a value stay."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def export_star(tables: Mapping[str, DataFrame], base: str) -> None:
    """Every curated table as a CSV folder."""
    for name, df in tables.items():
        export_csv(df, f"{base}/{name}")


def json_message(
    df: DataFrame, fields: list[str], topic: str, key: str = "customer_id", keep: Sequence[str] = ()
) -> DataFrame:
    """Keyed JSON messages; NULL fields are kept as ``null``, a missing key becomes ``unknown``. ``keep`` names
    columns to carry beside the message."""
    payload = F.struct(*[F.coalesce(key, F.lit("unknown")).alias(f) if f == key else F.col(f) for f in fields])
    return df.select(
        F.coalesce(key, F.lit("unknown")).alias("key"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("value"),
        F.lit(topic).alias("topic"),
        *keep,
    )


def order_messages(orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return json_message(orders, schemas.RAW_SCHEMAS["orders"].names, schemas.ORDERS_TOPIC, keep=keep)


def logistics_messages(orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One message per delivered order, with the dates under their event names."""
    delivered = F.col("order_delivered_customer_date")
    renamed = orders.filter(delivered.isNotNull() & (delivered != "")).select(
        "order_id",
        "customer_id",
        F.col("order_delivered_carrier_date").alias("delivered_carrier_date"),
        delivered.alias("delivered_customer_date"),
        F.col("order_estimated_delivery_date").alias("estimated_delivery_date"),
        *keep,
    )
    return json_message(renamed, schemas.LOGISTICS_PAYLOAD.names, schemas.LOGISTICS_TOPIC, keep=keep)


def publish(messages: DataFrame, bootstrap_servers: str) -> None:
    """Send key/value/topic rows to a broker (needs the Kafka connector on the class path)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()
