"""Scans: text files, pages, lookups, time ranges, relational tables and the table catalog."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira import schemas
from feira.sources.quoted import read_quoted_csv

MAX_PAGE_ROWS = 10_000


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False) -> DataFrame:
    """Header CSV as text columns: no inference, so zip codes keep their zeros. Byte-order mark, quoted commas and
    doubled quotes are understood. Columns are matched by position.

    Files are split over tasks. ``line_breaks=True`` is for files with line breaks inside quotes: it costs one more
    scan, which finds out where records start.
    """
    if line_breaks:
        return read_quoted_csv(spark, path, schema)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def as_raw(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Any typed table as an all-text raw table: declared columns, values turned to text."""
    return df.select(*[F.col(f.name).cast("string").alias(f.name) for f in schema.fields])


def with_ingestion_time(df: DataFrame) -> DataFrame:
    return df.withColumn(schemas.INGESTED_AT, F.current_timestamp())


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at ``path``, or an empty table of the same schema when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Bulk pull of a relational table in parallel ranges of a numeric column. The bounds only shape the ranges; rows
    outside them are read as well."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=dict(properties or {}),
    )


def check_page(page: int, size: int) -> None:
    if page < 1 or not 1 <= size <= MAX_PAGE_ROWS:
        raise ValueError(f"page must be >= 1 and size in 1..{MAX_PAGE_ROWS}, got page={page} size={size}")


def _slice(df: DataFrame, order_by: list[str | Column], page: int, size: int) -> DataFrame:
    """One plan for all pages: the tasks' own best rows. ``page_after`` reads on from a key without skipping rows."""
    return df.orderBy(*order_by).offset((page - 1) * size).limit(size)


def page(df: DataFrame, key: str, page: int = 1, size: int = 100) -> DataFrame:
    """One page in key order (ties by the other columns) with the table's total row count beside every row."""
    check_page(page, size)
    others = [c for c in df.columns if c != key]
    total = df.agg(F.count("*").alias("n")).scalar()
    return _slice(df, [key, *others], page, size).withColumn("total_rows", total)


def page_after(df: DataFrame, key: str, last_key: str | None, size: int = 100) -> DataFrame:
    """Next page after a unique key: a filter that reaches the scan instead of skipping rows."""
    check_page(1, size)
    rest = df if last_key is None else df.filter(F.col(key) > F.lit(last_key))
    return rest.orderBy(key).limit(size)


def in_range(
    df: DataFrame, time_col: str, start: str | None = None, end: str | None = None, end_inclusive_day: bool = False
) -> DataFrame:
    """Rows with ``start <= time <= end``, whole; both bounds are literals that reach the scan.

    ``end_inclusive_day`` counts the whole day of ``end`` in.
    """
    chosen = df
    if start is not None:
        chosen = chosen.filter(F.col(time_col) >= F.lit(start).cast("timestamp"))
    if end is not None:
        bound = F.lit(end).cast("timestamp")
        if end_inclusive_day:
            chosen = chosen.filter(F.col(time_col) < F.date_add(F.to_date(bound), 1).cast("timestamp"))
        else:
            chosen = chosen.filter(F.col(time_col) <= bound)
    return chosen


def time_range(
    df: DataFrame,
    time_col: str,
    start: str | None = None,
    end: str | None = None,
    page: int = 1,
    size: int = 100,
    end_inclusive_day: bool = False,
) -> DataFrame:
    """One page of ``in_range`` in time order, with the number of rows in the range."""
    check_page(page, size)
    chosen = in_range(df, time_col, start, end, end_inclusive_day)
    total = chosen.agg(F.count("*").alias("n")).scalar()
    others = [c for c in df.columns if c != time_col]
    return _slice(chosen, [time_col, *others], page, size).withColumn("total_rows", total)


def lookup(tables: Mapping[str, DataFrame], table: str, value: str, keys: Mapping[str, str] | None = None) -> DataFrame:
    """First row of ``table`` whose declared key column equals ``value``; empty when there is none."""
    keys = schemas.LOOKUP_KEYS if keys is None else keys
    if table not in tables or table not in keys:
        raise KeyError(f"unknown table {table!r}")
    df = tables[table]
    return df.filter(F.col(keys[table]) == F.lit(value)).orderBy(*df.columns).limit(1)


def catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every table with its row count, in name order."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def empty_like(df: DataFrame) -> DataFrame:
    """The schema of a table without reading a row."""
    return df.limit(0)


def schema_rows(tables: Mapping[str, DataFrame]) -> list[tuple[str, int, str, str]]:
    """(table, position, column, type) of every column of the tables, without reading a row."""
    return [
        (name, place, field.name, field.dataType.simpleString())
        for name, df in sorted(tables.items())
        for place, field in enumerate(empty_like(df).schema.fields)
    ]
