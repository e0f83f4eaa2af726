"""Events of a key in the order of their sequence numbers, however they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState

from feira.session import configure

PLACE = "place"
_KEY = "__key"
#: Sequence numbers of a block.
BLOCK = 1 << 14
#: Bytes of events of a key that a task gathers before it writes them to their blocks.
_GATHERED = 64 << 20


def _stored(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _loaded(stored: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(stored).read_pandas()


def hold_back(sequence: str, first: int, patience_ms: int | None) -> Callable:
    """Releases the events of one block of a key; its state is the next sequence number, the next place, and the block's
    events that wait, as Arrow bytes."""

    def release(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        expected, place, waiting = state.get if state.exists else (first, 0, b"")
        parts = [_loaded(waiting)] if waiting else []
        parts += [pdf for pdf in batches if len(pdf)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        # Numbers that are out already, or wait twice, are replays.
        rows = rows[rows[sequence] >= expected].drop_duplicates(sequence).sort_values(sequence, ignore_index=True)
        numbers = rows[sequence].to_numpy()
        gap = numbers != expected + np.arange(len(numbers))
        ready = int(gap.argmax()) if gap.any() and not state.hasTimedOut else len(rows)
        if ready:
            expected = int(numbers[ready - 1]) + 1
        held = rows.iloc[ready:]
        state.update((expected, place + ready, _stored(held) if len(held) else b""))
        if len(held) and patience_ms:
            state.setTimeoutDuration(patience_ms)
        yield rows.iloc[:ready].assign(**{PLACE: np.arange(place, place + ready, dtype=np.int64)})

    return release


class _BlockState:
    """One block of a key as the state of ``hold_back``."""

    exists = True

    def __init__(self, expected: int, place: int, timed_out: bool):
        self.get, self.hasTimedOut = (expected, place, b""), timed_out

    def update(self, value: tuple[int, int, bytes]) -> None:
        self.get = value


class Ordered(StatefulProcessor):
    """``hold_back`` over the blocks of a key, which it loads one at a time.

    What waits is kept by block of ``block`` sequence numbers, in parts as they came; a part is written and read whole.
    """

    def __init__(self, columns: list[str], sequence: str, first: int, patience_ms: int | None, block: int = BLOCK):
        self._columns, self._sequence, self._first = columns, sequence, first
        self._patience_ms, self._block = patience_ms, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._progress = handle.getValueState("progress", "sequence bigint, place bigint")
        self._waiting = handle.getMapState("waiting", "block bigint", "parts int")
        self._parts = handle.getMapState("parts", "block bigint, part int", "events binary")

    def _reached(self) -> tuple[int, int]:
        expected, place = self._progress.get() or (self._first, 0)
        return int(expected), int(place)

    def _by_block(self, gathered: list[pd.DataFrame]) -> dict[int, pd.DataFrame]:
        if not gathered:
            return {}
        rows = pd.concat(gathered, ignore_index=True)
        return {int(b): part for b, part in rows.groupby(rows[self._sequence] // self._block, sort=False)}

    def _put(self, parts: dict[int, pd.DataFrame]) -> None:
        for block, rows in parts.items():
            (n,) = self._waiting.getValue((block,)) or (0,)
            self._parts.updateValue((block, int(n)), (_stored(rows),))
            self._waiting.updateValue((block,), (int(n) + 1,))

    def _kept(self, block: int) -> Iterator[pd.DataFrame]:
        (n,) = self._waiting.getValue((block,)) or (0,)
        for part in range(int(n)):
            yield _loaded(bytes(self._parts.getValue((block, part))[0]))

    def _replace(self, block: int, held: bytes) -> None:
        (n,) = self._waiting.getValue((block,)) or (0,)
        for part in range(int(bool(held)), int(n)):
            self._parts.removeKey((block, part))
        if held:
            self._parts.updateValue((block, 0), (held,))
            self._waiting.updateValue((block,), (1,))
        elif n:
            self._waiting.removeKey((block,))

    def _release(self, block: int, new: Iterable[pd.DataFrame], timed_out: bool) -> Iterator[pd.DataFrame]:
        state = _BlockState(*self._reached(), timed_out)
        rows = (pdf for pdfs in (self._kept(block), new) for pdf in pdfs)
        for out in hold_back(self._sequence, self._first, None)((), rows, state):
            if len(out):
                yield out
        expected, place, held = state.get
        self._progress.update((expected, place))
        self._replace(block, held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        expected, _ = self._reached()
        gathered, size, touched = [], 0, set()
        for pdf in rows:
            # Names that are no Python names are lost on the way.
            pdf = pdf.set_axis(self._columns, axis=1).drop(columns=_KEY)
            # Numbers that are out already are replays.
            pdf = pdf[pdf[self._sequence] >= expected]
            gathered.append(pdf)
            size += int(pdf.memory_usage(deep=True).sum())
            if size > _GATHERED:
                parts = self._by_block(gathered)
                touched.update(parts)
                self._put(parts)
                gathered, size = [], 0
        parts = self._by_block(gathered)
        gathered.clear()
        block = expected // self._block
        # Where nothing came for the block of the next number, nothing can be released.
        open_ = block in touched or block in parts
        while open_:
            new = [parts.pop(block)] if block in parts else []
            yield from self._release(block, new, False)
            open_ = self._reached()[0] // self._block > block
            block += 1
        self._put(parts)
        if self._patience_ms:
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
            if self._waiting.exists():
                self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._patience_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for block in sorted(int(b) for (b,) in self._waiting.keys()):
            yield from self._release(block, [], True)

    def close(self) -> None:
        pass


def _key(stream: DataFrame, keys: list[str]) -> Column:
    """The keys as one string that is never null: null keys and numbers beside them come to Python as floats."""
    kinds = {f.name: f.dataType for f in stream.schema.fields}

    def text(name: str) -> Column:
        value = F.col(name)
        if isinstance(kinds.get(name), T.BinaryType):
            return F.hex(value)
        if isinstance(kinds.get(name), T.FloatType | T.DoubleType):
            # -0.0 is 0.0.
            value = value + F.lit(0.0)
        return value.cast("string")

    return F.to_json(F.struct(*[text(k).alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})


def in_order(
    stream: DataFrame, keys: list[str], sequence: str, first: int = 0, patience: str | None = None, block: int = BLOCK
) -> DataFrame:
    """The stream with ``place``: 0, 1, ... per key in the order of its gapless ``sequence`` numbers from ``first`` on.

    An event is held until all earlier ones of its key have come, so no batch has an event before one it follows.
    Repeats of a number are dropped. Rows without a sequence number are left out. If a number stays away for
    ``patience`` (processing time), the gap is skipped and what waits is released in order; what comes for it later is
    dropped. Without it a gap is waited for, over restarts too; catch-up runs go without, as a query with timers always
    has another batch to run.

    What waits lies in the state store in blocks of ``block`` sequence numbers, which must stay the same for a checkpoint.
    A task has one block of a key in memory and what it gathers of a batch before it writes that to its blocks, however
    much waits. Rows and blocks cross to Python and back, as numbered releases have no JVM-side form in Python.
    """
    configure(stream.sparkSession)
    ms = int(pd.Timedelta(patience).total_seconds() * 1000) if patience else None
    shape = T.StructType(stream.schema.fields + [T.StructField(PLACE, T.LongType())])
    keyed = stream.filter(F.col(sequence).isNotNull()).withColumn(_KEY, _key(stream, keys))
    return keyed.groupBy(_KEY).transformWithStateInPandas(
        Ordered(keyed.columns, sequence, first, ms, block), shape, "append", "ProcessingTime" if ms else "None"
    )
