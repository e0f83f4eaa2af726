"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.session import configure


_shipped: set[str] = set()


#: Rows and bytes of a batch between Spark and its Python workers: texts are long, and a few megabytes are enough.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def ship(spark: SparkSession) -> None:
    """Give this package to the application's Python workers, once, and keep their batches small."""
    for key, value in BATCH_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="feira-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    made = shutil.make_archive(f"{folder}/feira", "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(made)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def small_batches(batches: Iterable[pa.RecordBatch], text: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` text bytes, so that very long texts do not meet in one batch."""
    for batch in batches:
        start = size = 0
        lengths = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(text)] if batch.num_rows else []
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)
