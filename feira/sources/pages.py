"""Pages of a sorted table at any depth."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.session import materialize
from feira.sources.readers import check_page

_SLICE, _POSITION = "__slice", "__position"


class PageIndex:
    """A table sorted once into written slices whose first ranks are known, so a page reads only the slices it is in.

    ``readers.page`` needs no preparation but moves offset + limit rows into one task; behind a few thousand pages, or
    for a client that reads page after page, this index costs one sort and then a bounded read a page. Rows that tie on
    ``order_by`` are ordered by the remaining columns. The copy lies in the scratch area and shows the table as it was.
    """

    def __init__(self, df: DataFrame, order_by: list[str | Column]):
        named = {c for c in order_by if isinstance(c, str)}
        self.columns = df.columns
        placed = df.orderBy(*order_by, *[c for c in df.columns if c not in named]).select(
            *df.columns,
            F.spark_partition_id().alias(_SLICE),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(_POSITION),
        )
        # One file per slice: its smallest and largest slice number let a scan pass over all others.
        self.written = materialize(placed, "page-slices")
        sizes = sorted((r[0], r[1]) for r in self.written.groupBy(_SLICE).count().collect())
        self.slices = [s for s, _ in sizes]
        self.first = [0, *accumulate(n for _, n in sizes)]

    @property
    def total_rows(self) -> int:
        return self.first[-1]

    def pages(self, size: int) -> int:
        return -(-self.total_rows // size)

    def rows(self, start: int, stop: int) -> DataFrame:
        """Rows ``start`` to ``stop`` - 1 in order, read from the slices that hold them."""
        start, stop = max(0, start), min(stop, self.total_rows)
        if start >= stop:
            return self.written.limit(0).select(*self.columns)
        places = range(bisect_right(self.first, start) - 1, bisect_right(self.first, stop - 1))
        held = [p for p in places if p < len(self.slices)]
        chosen = F.lit(False)
        for p in held:
            chosen = chosen | (
                (F.col(_SLICE) == self.slices[p])
                & F.col(_POSITION).between(start - self.first[p], stop - 1 - self.first[p])
            )
        return self.written.filter(chosen).orderBy(_SLICE, _POSITION).select(*self.columns)

    def page(self, page: int = 1, size: int = 100) -> DataFrame:
        """One page with the table's total row count beside every row; empty behind the last one."""
        check_page(page, size)
        return self.rows((page - 1) * size, page * size).withColumn("total_rows", F.lit(self.total_rows).cast("bigint"))
