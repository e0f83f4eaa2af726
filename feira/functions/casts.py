"""Lenient casts: dirty source text becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira import schemas

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
_TIMESTAMP_SHAPE = r"\A\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"


def to_timestamp(col: Column | str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text in exactly this format to a timestamp. The default format is checked by shape and then cast, which costs
    about half of running a formatter."""
    text = F.col(col) if isinstance(col, str) else col
    if fmt == TIMESTAMP_FORMAT:
        return F.when(text.rlike(_TIMESTAMP_SHAPE), text.try_cast("timestamp"))
    return F.try_to_timestamp(text, F.lit(fmt))


def iso_timestamp(col: Column | str) -> Column:
    """ISO-8601 text, ``Z`` included, to a timestamp."""
    text = F.col(col) if isinstance(col, str) else col
    return text.try_cast("timestamp")


def to_double(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).try_cast("double")


def to_int(col: Column | str) -> Column:
    """Both ``'5'`` and ``'5.0'`` are 5: sources that went through a float column write the latter."""
    return to_double(col).try_cast("int")


def apply_table_casts(df: DataFrame, table: str) -> DataFrame:
    """One projection holding every cast the table declares; undeclared columns pass through."""
    casts = {
        **{c: to_timestamp for c in schemas.TIMESTAMP_COLUMNS.get(table, ())},
        **{c: to_double for c in schemas.DOUBLE_COLUMNS.get(table, ())},
        **{c: to_int for c in schemas.INTEGER_COLUMNS.get(table, ())},
    }
    return df.select(*[casts[c](c).alias(c) if c in casts else F.col(c) for c in df.columns])
