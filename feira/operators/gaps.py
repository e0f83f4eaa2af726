"""Time between neighbouring events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.operators.keys import with_previous


def event_gaps(df: DataFrame, time_col: str, tie_break: list[str], gap_col: str = "gap_seconds") -> DataFrame:
    """Seconds since the event before it in the global time order; NULL for the first and where a time is missing."""
    timed = df.withColumn("__micros", F.unix_micros(time_col))
    neighbours = with_previous(timed, [time_col, *tie_break], "__micros", "__previous")
    gap = (F.col("__micros") - F.col("__previous")) / 1_000_000
    return neighbours.select(*df.columns, gap.alias(gap_col))
