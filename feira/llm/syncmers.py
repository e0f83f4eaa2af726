"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer when the least of its inner s-mers, by hash, is its first or its last. That
depends on the k-mer alone, so the same passage yields the same anchors wherever it stands, and an edit moves only the
anchors it touches. ``anchors`` returns them with their positions. Texts at hand are compared by all of them, up to
collisions of 32-bit hashes: ``jaccard`` is the share of common anchors, ``shared_passages`` the places where they stand.

A fingerprint is the whole set of distinct anchor hashes, sorted, in base64 (about as long as an ASCII text): it grows with
the text, so one changed word of a long text shows, fingerprints of parts can be united, and ``likeness`` of two
fingerprints is the exact share of their common anchors.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from feira.llm.common import col, ship, small_batches, text_or_empty

K, S = 20, 11
#: Ids drawn for each cut between blocks of ids that have no quantiles, such as strings.
DRAWN = 64
_A = np.uint32(0x01000193)


def _power(n: int) -> np.uint32:
    return np.uint32(pow(int(_A), n, 1 << 32))


def _mers(codes: np.ndarray, size: int) -> np.ndarray:
    """32-bit hashes of all runs of ``size`` code points, by doubling."""
    now = (codes ^ (codes >> np.uint32(7))) * np.uint32(0x9E3779B1) + np.uint32(0x85EBCA6B)
    out, done, width = None, 0, 1
    while True:
        if size & width:
            if out is None:
                out = now
            else:
                # What is done already stands behind this power of two.
                m = len(codes) - done - width + 1
                out = now[:m] * _power(done) + out[width : width + m]
            done += width
        width *= 2
        if done == size:
            break
        m = len(codes) - width + 1
        now = now[:m] * _power(width // 2) + now[width // 2 : width // 2 + m]
    out = (out ^ (out >> np.uint32(16))) * np.uint32(0x7FEB352D)
    out = (out ^ (out >> np.uint32(15))) * np.uint32(0x846CA68B)
    return out ^ (out >> np.uint32(16))


def _whole_hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes of the closed syncmers of a whole text.

    A text without any (such as one shorter than k) is its own single anchor; an empty text has none.
    """
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    whole = np.zeros(1, np.int64), np.array([_whole_hash(text)], np.uint32)
    if len(text) < k:
        return whole
    inner = _mers(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), s)
    width = k - s + 1
    least, span = inner, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    n = len(text) - k + 1
    at = np.flatnonzero((inner[:n] == least) | (inner[width - 1 :] == least))
    if not len(at):
        return whole
    # Two inner s-mers, first and last, cover the k-mer.
    both = (inner[at].astype(np.uint64) << np.uint64(32)) | inner[at + width - 1]
    both = (both ^ (both >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    both = (both ^ (both >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return at, (both >> np.uint64(32)).astype(np.uint32)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common values of two whole sets of distinct anchor hashes. Empty = empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, True))
    return common / (len(a) + len(b) - common)


def shared_passages(
    text: str, found: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the passages of ``text`` made of anchors that the other text has too, and the first place of
    each passage's first anchor in the other text.

    ``found`` and ``other`` are the ``anchors`` of the two texts. Two anchors follow each other within K - S places, so a
    common passage is found in one piece, less at most K - S code points at either end.
    """
    at, hashes = found
    distinct, first = np.unique(other[1], return_index=True)
    if not len(at) or not len(distinct):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(distinct, hashes), len(distinct) - 1)
    common = distinct[place] == hashes
    begin, there = at[common], other[0][first[place[common]]]
    # A text without anchors is one itself.
    own = len(at) == 1 and hashes[0] == _whole_hash(text)
    end = begin + (len(text) if own else K)
    fresh = np.flatnonzero(np.concatenate([np.ones(min(1, len(begin)), bool), begin[1:] > end[:-1]]))
    last = np.concatenate([fresh[1:], np.full(min(1, len(begin)), len(begin))]) - 1
    return begin[fresh], end[last] - begin[fresh], there[fresh]


def as_text(values: np.ndarray) -> str:
    return base64.b64encode(values.astype(">u4").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u4").astype(np.uint32)


def likeness(fingerprint: str, other: str) -> float:
    """Share of common anchors of two fingerprints."""
    return jaccard(from_text(fingerprint), from_text(other))


def anchor_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, positions and hashes of the anchors, and the fingerprint, of each row's whole text (null: empty)."""
    ship(df.sparkSession)
    work = df.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches([batch], "text"):
                texts = part.column("text").to_pylist()
                found = [anchors(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([f[0].tolist() for f in found], pa.list_(pa.int64())),
                        pa.array([f[1].tolist() for f in found], pa.list_(pa.int64())),
                        pa.array([as_text(np.unique(f[1])) for f in found], pa.string()),
                    ],
                    ["id", "positions", "hashes", "fingerprint"],
                )

    kind = work.schema["id"].dataType.simpleString()
    schema = f"id {kind}, positions array<bigint>, hashes array<bigint>, fingerprint string"
    return work.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _block(value: Column, bounds: list) -> Column:
    """Number of bounds that are not above ``value``, looked up in two levels."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    coarse = F.size(F.filter(F.array(*[F.lit(g[0]) for g in groups]), lambda b: b <= value))
    group = F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in groups]), F.greatest(coarse, F.lit(1)))
    fine = F.size(F.filter(group, lambda b: b <= value))
    return F.when(value.isNull() | (coarse == 0), 0).otherwise((coarse - 1) * step + fine).cast("int")


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text, block, carried) dealt to tasks by blocks of ids and sorted, the first row of each block also at
    the end of the block before it (and the very first one at the end of the last).

    Blocks are cut at approximate quantiles of the id, as many as shuffle partitions (for ids that aren't numbers, at
    quantiles of ``DRAWN`` random ones per block); only the cuts and each block's first row (id and a hash) reach the
    driver. Whole texts are shuffled once.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = df.select(col(id_col).alias("id"))
    shares = [i / parts for i in range(1, parts)]
    if isinstance(ids.schema["id"].dataType, NumericType):
        cuts = ids.select(F.percentile_approx("id", shares, 10 * parts)).first()[0] if shares else []
    else:
        drawn = ids.filter("id is not null").orderBy(F.rand(11)).limit(DRAWN * parts).collect()
        known = sorted(r.id for r in drawn)
        cuts = [known[int(share * len(known))] for share in shares] if known else []
    bounds = sorted(set(cuts or []))
    work = df.select(
        col(id_col).alias("id"), text_or_empty(text_col).alias("text"), _block(col(id_col), bounds).alias("block")
    ).withColumn("text_hash", F.xxhash64("text"))
    head = work.groupBy("block").agg(F.min_by(F.struct("id", "text_hash"), F.struct("id", "text_hash")).alias("head"))
    heads = sorted(head.select("block", "head.id", "head.text_hash").collect())
    before = [(heads[i - 1][0], *heads[i][1:]) for i in range(len(heads))]
    kind = work.schema["id"].dataType.simpleString()
    # One row per block.
    sent = F.broadcast(spark.createDataFrame(before, f"to_block int, head_id {kind}, head_hash bigint"))
    found = work.join(sent, F.col("id").eqNullSafe(F.col("head_id")) & (F.col("text_hash") == F.col("head_hash")), "left")
    copies = F.array(
        F.struct(F.col("block").alias("block"), F.lit(False).alias("carried")),
        F.struct(F.col("to_block").alias("block"), F.lit(True).alias("carried")),
    )
    spread = found.withColumn("to", F.when(F.col("to_block").isNull(), F.slice(copies, 1, 1)).otherwise(copies))
    dealt = spread.select("id", "text", "text_hash", F.inline("to"))
    return dealt.repartitionById(max(1, len(bounds) + 1), F.col("block")).sortWithinPartitions(
        "block", "carried", "id", "text_hash"
    )


_NEW = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, shared_next bigint, longest_next bigint"
)


def edited_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint and that of an edited copy, and all its anchors against those of the edited copy and
    those of the next document in order of id.

    ``near_edited`` and ``near_next`` are the ``likeness`` of the fingerprints. ``shared_next`` is the number of
    the document's code points in passages that the next document has too, ``longest_next`` the longest such passage.

    In the edited copy the last floor(n/2) code points are replaced by the first as many (or all) of the next document.
    Null texts are empty, null ids come first; rows that share an id are ordered by a hash of their text. A single row
    is its own next. An empty table gives an empty result.
    """
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = None  # the last document, which waits for its next one
        for batch in batches:
            for part in small_batches([batch], "text"):
                columns = [part.column(c).to_pylist() for c in ("id", "text", "block", "carried")]
                for name, text, block, carried in zip(*columns, strict=True):
                    own = _Anchored(text)
                    if held and held[2] == block:
                        rows.append(_compared(held[0], held[1], own))
                    held = None if carried else (name, own, block)
                yield _batch(rows, batch.schema.field("id").type)
                rows = []

    out = with_next(df, id_col, text_col).drop("text_hash").mapInArrow(run, f"id {kind}, {_NEW}")
    return out.withColumnRenamed("id", id_col)


class _Anchored:
    """A text, its anchors and their distinct hashes in order, which are its fingerprint."""

    def __init__(self, text: str):
        self.text, self.found = text, anchors(text)
        self.distinct = np.unique(self.found[1])


def _compared(name, own: _Anchored, following: _Anchored) -> tuple:
    text = own.text
    half = len(text) // 2
    edited = text[: len(text) - half] + following.text[:half]
    other = np.unique(anchors(edited)[1])
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    near = jaccard(own.distinct, other), jaccard(own.distinct, following.distinct)
    lengths = shared_passages(text, own.found, following.found)[1]
    shared = int(lengths.sum()), int(lengths.max(initial=0))
    return name, len(text), digest, as_text(own.distinct), as_text(other), *near, *shared


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    types += [pa.int64(), pa.int64()]
    names = ["id", *[c.split()[0] for c in _NEW.split(", ")]]
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
