"""CSV files with line breaks inside quotes, read in parallel.

Such a break hides where records start: whether a line begins one depends on all quotes before it in the file. Files
are split as usual. A first scan sums the quotes of every split; the parity of the sums before it tells whether a split
begins inside quotes. A second scan follows the parity line by line and puts the lines of each record together where it
reads them, so no text is shuffled but the pieces of the (at most one) record that reaches over the end of a split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.session import materialize

_RECORDS = "file bigint, split bigint, place int, starts boolean, header boolean, record string"
_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


class _Split:
    """Puts the lines of one split together, batch by batch."""

    def __init__(self, file: int, split: int, inside: bool):
        self.file, self.split = file, split
        self.parity = int(inside)
        self.open: list[str] = []
        #: Whether the open record began in an earlier split.
        self.carried = inside
        #: The first record of a file is its header.
        self.header_next, self.header_open = split == 0, False
        self.pieces: list[tuple] = []

    def add(self, lines: pa.Array) -> pa.Array:
        """Takes lines in file order and returns those that are whole records of one line."""
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
        after = (self.parity + np.cumsum(odd)) & 1
        before = np.append(self.parity, after[:-1])
        alone = (before == 0) & (after == 0)
        start = 0
        if self.header_next:
            # A header of one line is passed over, a longer one dropped when it closes.
            self.header_next, self.header_open, start = False, not alone[0], int(alone[0])
            alone[0] = False
        for i in (start + np.flatnonzero(~alone[start:])).tolist():
            self.open.append(lines[i].as_py())
            if not after[i]:
                self._close()
        self.parity = int(after[-1])
        return lines.filter(pa.array(alone))

    def _close(self) -> None:
        text = "\n".join(self.open)
        if self.carried:
            self.pieces.append((0, False, False, text))
        elif not self.header_open:
            self.pieces.append((None, True, False, text))
        self.open, self.carried, self.header_open = [], False, False

    def end(self) -> None:
        """The split is over: what is open goes on in the next one."""
        if self.open or self.carried:
            place = 0 if self.carried else 1
            self.pieces.append((place, not self.carried, self.header_open, "\n".join(self.open) if self.open else None))

    def batch(self, alone: pa.Array) -> pa.RecordBatch:
        """Whole records, and pieces of records that lie in several splits, as far as they are known."""
        pieces, self.pieces = self.pieces, []
        n = len(alone) + len(pieces)

        def column(values: list, rest: object, kind: pa.DataType) -> pa.Array:
            return pa.array([rest] * len(alone) + values, kind)

        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.file] * n, pa.int64()),
                pa.array([self.split] * n, pa.int64()),
                column([p[0] for p in pieces], None, pa.int32()),
                column([p[1] for p in pieces], True, pa.bool_()),
                column([p[2] for p in pieces], False, pa.bool_()),
                pa.concat_arrays([alone, pa.array([p[3] for p in pieces], pa.string())]),
            ],
            ["file", "split", "place", "starts", "header", "record"],
        )


def _join_lines(inside: frozenset) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.array([], pa.string())
        now: _Split | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, split = (batch.column(c).to_numpy() for c in ("file", "split"))
            lines = batch.column("value").cast(pa.string())
            cuts = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)], strict=True):
                key = int(file[a]), int(split[a])
                if now is None or (now.file, now.split) != key:
                    if now is not None:
                        now.end()
                        yield now.batch(none)
                    now = _Split(*key, key in inside)
                yield now.batch(now.add(lines.slice(a, b - a)))
        if now is not None:
            now.end()
            yield now.batch(none)

    return work


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV whose quoted values may hold line breaks, commas and doubled quotes; many tasks share a file.

    Columns are matched by position. Records end at ``\\n`` or ``\\r\\n``; a break inside quotes stays as it is. Blank
    lines between records are no records. Quotes stand at the ends of a value or doubled inside a quoted one: a file
    whose quotes do not pair raises an error instead of giving shifted rows. The files must not change while they are
    read. Only the numbers of splits that begin inside quotes visit the driver.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    sums = materialize(
        lines.select(*place, F.col("_metadata.file_path").alias("path"), quotes.alias("quotes"))
        .groupBy("file", "split")
        .agg(F.sum("quotes").alias("quotes"), F.first("path").alias("path")),
        "csv-quotes",
    )
    broken = sums.groupBy("path").agg(F.sum("quotes").alias("n")).filter("n % 2 = 1").select("path").limit(3).collect()
    if broken:
        raise ValueError(f"quotes do not pair in {', '.join(r.path for r in broken)}")
    earlier = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    started = sums.select("file", "split", F.sum("quotes").over(earlier).alias("before")).filter("before % 2 = 1")
    inside = frozenset((r.file, r.split) for r in started.select("file", "split").collect())
    records = materialize(lines.select(*place, "value").mapInArrow(_join_lines(inside), _RECORDS), "csv-records", "zstd")
    # Pieces in file order; the one that starts a record counts it up.
    in_file = W.partitionBy("file").orderBy("split", "place")
    pieces = records.filter("place is not null").withColumn("number", F.sum(F.col("starts").cast("int")).over(in_file))
    joined = (
        pieces.groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("split", "place", "record"))).alias("parts"), F.max("header").alias("header"))
        .filter("not header")
        .select(
            F.array_join(F.transform(F.filter("parts", lambda p: p["record"].isNotNull()), lambda p: p["record"]), "\n")
            .alias("record")
        )
    )
    text = records.filter("place is null").select("record").unionByName(joined)
    text = text.select(F.regexp_replace("record", "\r$", "").alias("record")).filter(F.trim("record") != "")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", shape, _OPTIONS)
    return text.select(parsed.alias("row")).select("row.*")
