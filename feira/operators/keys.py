"""Global positions without a single-partition window: dense keys, chronological splits, deep pages, global lag."""

from __future__ import annotations

from itertools import takewhile
from typing import Literal, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.session import materialize

_SLICE, _POSITION, _BEFORE, _ARRIVAL = "__slice", "__position", "__rows_before", "__arrival"


class Ranked(NamedTuple):
    """Rows with a dense 1-based global position, and how many there are."""

    df: DataFrame
    rows: int


Unique = bool | Literal["collapse"]


def global_rank(df: DataFrame, order_by: list[str | Column], rank_col: str, unique: Unique = False) -> Ranked:
    """Number all rows 1..n in ``order_by`` order.

    The input is evaluated once and written; sampling and sorting read that copy, the sample only its sort columns.
    A range exchange sorts the rows into ordered slices (Spark samples the whole sort tuple, so a leading value that
    holds a third of the rows is still split by the columns behind it). Slice number and place in the slice are
    written once, which also freezes the slice bounds against recomputation; the rank is then the place plus the
    number of rows in earlier slices. Only those slice sizes, at most one per shuffle partition, visit the driver.

    Rows that tie on the whole ``order_by`` are told apart by an arrival number that is written with them first, so
    even copies that make up a third of the table are split over slices, and a retried task numbers them as before.
    ``unique=True`` says that there are no ties and saves that number. ``unique="collapse"`` keeps one row of those that
    are equal in all columns: the range exchange has brought them into one slice, so that takes no exchange of its own.
    """
    spark, keys, columns = df.sparkSession, list(order_by), df.columns
    df = materialize(df if unique else df.withColumn(_ARRIVAL, F.monotonically_increasing_id()), "arrived", "zstd")
    if not unique:
        keys.append(_ARRIVAL)
    ordered = _one_of_ties(df, keys) if unique == "collapse" else df.orderBy(*keys)
    placed = ordered.select(
        *columns,
        F.spark_partition_id().alias(_SLICE),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(_POSITION),
    )
    written = materialize(placed, "ranked", "zstd")
    sizes = {r[0]: r[1] for r in written.groupBy(_SLICE).count().collect()}
    total, slices, before = 0, [], []
    for number in sorted(sizes):
        slices.append(number)
        before.append(total)
        total += sizes[number]
    offsets = spark.createDataFrame(
        pa.table({_SLICE: pa.array(slices, pa.int32()), _BEFORE: pa.array(before, pa.int64())})
    )
    ranked = written.join(F.broadcast(offsets), _SLICE)
    rank = (F.col(_BEFORE) + F.col(_POSITION) + 1).alias(rank_col)
    return Ranked(ranked.select(rank, *columns), total)


def _one_of_ties(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in slices ordered by the columns ``keys``, then the others, one row of those that are equal in all of them.

    Rows are dealt by range of the columns before the first floating one, whose values a window would normalise and deal
    anew; the window finds them in place, sorts every slice and looks at the row before.
    """
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, T.FloatType | T.DoubleType)}
    dealt = list(takewhile(lambda c: c not in floating, keys))
    others = [c for c in df.columns if c not in keys]
    if not dealt:
        return df.dropDuplicates().orderBy(*keys, *others)
    rest = keys[len(dealt) :] + others
    in_order = W.partitionBy(*dealt).orderBy(*(rest or dealt[:1]))
    repeats = F.row_number().over(in_order) > 1
    for c in rest:
        repeats = repeats & F.col(c).eqNullSafe(F.lag(c).over(in_order))
    marked = df.repartitionByRange(*dealt).withColumn("__repeats", repeats)
    return marked.filter(~F.col("__repeats")).drop("__repeats")


def dense_key(df: DataFrame, order_by: list[str | Column], key_col: str, unique: Unique = False) -> DataFrame:
    """Surrogate key 1..n without gaps, in ``order_by`` order."""
    return global_rank(df, order_by, key_col, unique).df


class Split(NamedTuple):
    head: DataFrame
    tail: DataFrame
    head_rows: int
    rows: int


def chronological_split(
    df: DataFrame, time_col: str, fraction: float = 0.9, tie_break: list[str] | None = None, rank_col: str = "__rank"
) -> Split:
    """Oldest ``fraction`` of the rows and the rest; ties on time are ordered by the remaining columns."""
    ties = tie_break if tie_break is not None else [c for c in df.columns if c != time_col]
    ranked = global_rank(df, [time_col, *ties], rank_col)
    cut = int(ranked.rows * fraction)
    head = ranked.df.filter(F.col(rank_col) <= cut)
    tail = ranked.df.filter(F.col(rank_col) > cut)
    if rank_col == "__rank":
        head, tail = head.drop(rank_col), tail.drop(rank_col)
    return Split(head, tail, cut, ranked.rows)


def with_previous(
    df: DataFrame,
    order_by: list[str | Column],
    value_col: str,
    previous_col: str,
    block_rows: int = 1_000_000,
    unique: bool = False,
) -> DataFrame:
    """Value of the row before each row in the global order (NULL for the first).

    Ranked rows fall into blocks of ``block_rows``; the last row of a block is also sent to the next block, so a
    window per block sees every neighbour and no block is larger than ``block_rows + 1``.
    """
    rank, block, carried = "__rank", "__block", "__carried"
    ranked = global_rank(df, order_by, rank, unique).df.withColumn(
        block, F.floor((F.col(rank) - 1) / block_rows).cast("bigint")
    )
    last_of_block = F.col(rank) % block_rows == 0
    copies = F.when(
        last_of_block,
        F.array(
            F.struct(F.col(block).alias(block), F.lit(False).alias(carried)),
            F.struct((F.col(block) + 1).alias(block), F.lit(True).alias(carried)),
        ),
    ).otherwise(F.array(F.struct(F.col(block).alias(block), F.lit(False).alias(carried))))
    spread = ranked.select(rank, *df.columns, F.inline(copies))
    in_block = W.partitionBy(block).orderBy(rank)
    return (
        spread.withColumn(previous_col, F.lag(value_col).over(in_block))
        .filter(~F.col(carried))
        .drop(rank, block, carried)
    )
