"""Packing documents into fixed-length token sequences: bounded-space online best fit.

Each task keeps a fixed number of open windows. A document goes to the window where it leaves the least room; when it
fits nowhere, the fullest window is emitted (its gap first takes the document's head, if worth a cut) and a new one is
opened. What is longer than a window fills whole windows first. The windows that are still open when a task ends are
merged in rounds, each with a fraction of the tasks of the one before, until one task holds at most ``FAN`` tasks'
leftovers; that one fills windows to the brim and cuts the rest into powers of two, which need no padding.

Emitted and left-over pieces of a pass are written together once, so a retried task can't make them disagree.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.common import col, ship, small_batches, text_or_empty
from feira.llm.tokens import encoder
from feira.session import materialize

WINDOW = 2048
OPEN_WINDOWS = 32
LEAST_CUT = 16
FAN = 32
END_ID = 1

_ROUND_BITS, _TASK_BITS = 56, 32
_SCHEMA = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, open boolean, ids binary"
)


class Packer:
    """Windows of one task. A piece is (doc_id, start, ids, doc_tokens); ``emit`` gets each finished window's pieces."""

    def __init__(self, emit, window: int, most_open: int, least_cut: int):
        self.emit, self.window, self.most_open, self.least_cut = emit, window, most_open, least_cut
        self.gaps: list[int] = []
        self.held: list[list[tuple]] = []

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        while len(ids) >= self.window:
            self.emit([(doc_id, start, ids[: self.window], doc_tokens)])
            start, ids = start + self.window, ids[self.window :]
        while len(ids):
            n = len(ids)
            best = min((gap, i) for i, gap in enumerate([*self.gaps, self.window]) if gap >= n)[1]
            if best == len(self.gaps):
                if len(self.gaps) == self.most_open:
                    fullest = self.gaps.index(min(self.gaps))
                    if (gap := self.gaps[fullest]) >= self.least_cut:
                        self.held[fullest].append((doc_id, start, ids[:gap], doc_tokens))
                        start, ids = start + gap, ids[gap:]
                    self._close(fullest)
                    continue
                self.gaps.append(self.window)
                self.held.append([])
            self.held[best].append((doc_id, start, ids, doc_tokens))
            self.gaps[best] -= n
            if not self.gaps[best]:
                self._close(best)
            return

    def _close(self, at: int) -> None:
        self.gaps.pop(at)
        self.emit(self.held.pop(at))

    def fill_up(self) -> None:
        """Emit what is open: whole windows, then one sequence for each power of two of the rest."""
        pieces = [p for held in self.held for p in held]
        self.gaps, self.held = [], []
        left = sum(len(p[2]) for p in pieces)
        room, now = self._room(left), []
        for doc_id, start, ids, doc_tokens in pieces:
            while len(ids):
                head, ids = ids[:room], ids[room:]
                now.append((doc_id, start, head, doc_tokens))
                start, room, left = start + len(head), room - len(head), left - len(head)
                if not room:
                    self.emit(now)
                    room, now = self._room(left), []

    def _room(self, left: int) -> int:
        return self.window if left >= self.window else 1 << max(0, left.bit_length() - 1)


class _Rows:
    """Piece rows of one task, in batches."""

    def __init__(self, id_type: pa.DataType, round_: int, with_ids: bool):
        self.types = [id_type, *[pa.int64()] * 6, pa.bool_(), pa.binary()]
        self.rows: list[tuple] = []
        self.next = (round_ << _ROUND_BITS) + (TaskContext.get().partitionId() << _TASK_BITS)
        self.with_ids = with_ids

    def window(self, pieces: list[tuple], is_open: bool = False) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            data = ids.astype("<u4").tobytes()
            kept = data if is_open or self.with_ids else None
            self.rows.append((doc_id, start, len(ids), zlib.crc32(data), doc_tokens, self.next, offset, is_open, kept))
            offset += len(ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(self.types)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "open", "ids"]
        arrays = [pa.array(c, t) for c, t in zip(columns, self.types, strict=True)]
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, names)


def pack(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    most_open: int = OPEN_WINDOWS,
    least_cut: int = LEAST_CUT,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, little-endian).

    ``tokenizer`` is the path of a tokenizer file, the same on all machines. Null texts are empty and yield the end id
    only. Every input row is a document of its own, repeated ids included; other columns are not read. Each id lies in
    exactly one piece; a sequence's pieces have gapless offsets from 0.
    """
    ship(df.sparkSession)
    work = df.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = work.schema["id"].dataType.simpleString()
    schema = _SCHEMA.format(id=kind)

    def first_pass(batches):
        rows = packer = None
        encode = encoder(tokenizer).encode
        for batch in batches:
            if rows is None:
                rows = _Rows(batch.schema.field("id").type, 0, with_ids)
                packer = Packer(rows.window, window, most_open, least_cut)
            for part in small_batches([batch], "text", 700_000):
                texts, names = part.column("text").to_pylist(), part.column("id").to_pylist()
                for name, ids in zip(names, encode(texts), strict=True):
                    packer.add(name, 0, np.append(ids, np.uint32(end_id)), len(ids) + 1)
            yield rows.batch()
        if rows is not None:
            for held in packer.held:
                rows.window(held, is_open=True)
            yield rows.batch()

    def merge(round_: int, last: bool):
        def run(batches):
            parts = list(batches)
            if not parts:
                return
            rows = _Rows(parts[0].schema.field("doc_id").type, round_, with_ids)
            packer = Packer(rows.window, window, most_open, least_cut)
            names = ["doc_id", "start", "doc_tokens", "ids"]
            pieces = list(zip(*[[v for p in parts for v in p.column(n).to_pylist()] for n in names], strict=True))
            for doc_id, start, doc_tokens, data in sorted(pieces, key=lambda p: -len(p[3])):
                packer.add(doc_id, start, np.frombuffer(data, "<u4"), doc_tokens)
            if last:
                packer.fill_up()
            for held in packer.held:
                rows.window(held, is_open=True)
            yield rows.batch()

        return run

    done = materialize(work.mapInArrow(first_pass, schema), "packed")
    out, round_ = done.filter(~F.col("open")), 1
    while left := done.filter("open").select("sequence_id").distinct().count():
        tasks = math.ceil(left / (FAN * most_open))
        pieces = done.filter("open").select("doc_id", "start", "doc_tokens", "ids", "sequence_id", "length")
        dealt = pieces.repartition(tasks, "sequence_id") if tasks > 1 else pieces.coalesce(1)
        dealt = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "start")
        done = materialize(dealt.mapInArrow(merge(round_, tasks == 1), schema), "packed-leftovers")
        out = out.unionByName(done.filter(~F.col("open")))
        if tasks == 1:
            break
        round_ += 1
    return out.drop("open") if with_ids else out.drop("open", "ids")
