"""Hard negatives by inner product: rows of another label that score just below an anchor's best rows of its own label.

Rows are dealt by length, so every task holds narrow ranges of lengths, and cuts them into buckets. A bucket keeps, for
each coordinate of its unit vectors, the rows sorted by that coordinate. An anchor that needs a score of at least theta
needs a cosine of at least theta / (its length x the longest length of the bucket): a bucket that would need more than
one is passed over, with all shorter ones. Else the anchor's largest coordinates are its focus: a unit vector within that
angle of the anchor has each focus coordinate in a known range, a range of the sorted list, and only rows that lie in
all of these ranges are scored exactly.

Anchors are a stated query set: they meet all rows in blocks of ``ANCHORS``, so what a task is given does not grow.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.llm.common import col, ship
from feira.llm.vectors import runs
from feira.session import materialize

POSITIVES = 5
NEGATIVES = 5
#: Negatives score between this percentage of the positive's score and that score.
LEAST_PERCENT = 80
ANCHORS = 8192
FOCUS = 4
_BUCKET = 4096
#: A bucket ends where a length falls below this share of its first.
_SAME_LENGTH = 0.9
_SCALE = 256
_EXACT = 1 << 53


class Bucket(NamedTuple):
    """Rows of similar length with their sorted coordinate lists (``order`` and ``values`` by coordinate)."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    whole: np.ndarray
    longest: float
    order: np.ndarray
    values: np.ndarray


def buckets(row: np.ndarray, id_: np.ndarray, label: np.ndarray, whole: np.ndarray) -> list[Bucket]:
    """Rows in buckets of falling length."""
    length = np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1))
    falling = np.argsort(-length, kind="stable")
    row, id_, label, whole, length = row[falling], id_[falling], label[falling], whole[falling], length[falling]
    made, start = [], 0
    while start < len(row):
        shorter = np.searchsorted(-length, -length[start] * _SAME_LENGTH, "right")
        part = slice(start, min(max(int(shorter), start + 1), start + _BUCKET))
        with np.errstate(invalid="ignore", divide="ignore"):
            unit = np.where(length[part, None] > 0, whole[part] / length[part, None], 0.0)
        order = np.argsort(unit, axis=0, kind="stable").T.copy()
        values = np.take_along_axis(unit.T, order, axis=1)
        made.append(Bucket(row[part], id_[part], label[part], whole[part], float(length[start]), order, values))
        start = part.stop
    return made


def feasible(bucket: Bucket, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
    """Places in the bucket of all rows that may reach ``cosine`` with the unit vector (and some that do not)."""
    n = len(bucket.row)
    if cosine > 1:
        return np.zeros(0, np.int64)
    if cosine <= -1:
        return np.arange(n)
    angle = math.acos(cosine) + 1e-7
    seen, lists = np.zeros(n, np.int8), 0
    for f in focus:
        at = math.acos(min(1.0, max(-1.0, unit[f])))
        low, high = math.cos(min(math.pi, at + angle)) - 1e-9, math.cos(max(0.0, at - angle)) + 1e-9
        a, b = np.searchsorted(bucket.values[f], [low, high], "left")
        if b - a < n:
            seen[bucket.order[f, a:b]] += 1
            lists += 1
    return np.flatnonzero(seen == lists)


def scores(anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    if float(np.abs(anchor).max()) * float(np.abs(rows).max()) * len(anchor) < _EXACT:
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(anchor, r, strict=True)) for r in rows], object)


class Best:
    """The first ``k`` (score, id, row) by falling score, then by id and row."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> float:
        """What a row must score to get in, ids aside."""
        return float(self.score[-1]) if len(self.score) == self.k else -math.inf

    def add(self, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        score, id_, row = (np.append(a, b) for a, b in ((self.score, score), (self.id, id_), (self.row, row)))
        order = np.lexsort((row, id_, -score))[: self.k]
        self.score, self.id, self.row = score[order], id_[order], row[order]


class Anchors(NamedTuple):
    """A block of anchors of one dimension; ``asked`` holds the positive scores of each, once they are known."""

    row: np.ndarray
    label: np.ndarray
    whole: np.ndarray
    asked: list[list[int]] | None = None


def _probe(anchors: Anchors, i: int) -> tuple[np.ndarray, float, np.ndarray]:
    whole = anchors.whole[i].astype(np.float64)
    length = float(np.sqrt(whole @ whole))
    unit = whole / length if length else whole
    return unit, length, np.argsort(-np.abs(unit), kind="stable")[:FOCUS]


def _needed(theta: float, length: float, longest: float) -> float:
    """Cosine that a score of ``theta`` takes in a bucket; a little less, for rounding. Below -1: anything goes."""
    reach = length * longest
    if theta <= 0 and reach == 0:
        return -2.0
    if reach == 0:
        return 2.0
    # Shorter rows need a smaller cosine only where theta is negative; there nothing is pruned.
    return theta / reach - 1e-9 if theta > 0 else -2.0


def search_positives(anchors: Anchors, found: list[Best], made: list[Bucket]) -> None:
    for i, best in enumerate(found):
        unit, length, focus = _probe(anchors, i)
        for bucket in made:
            cosine = _needed(best.least(), length, bucket.longest)
            if cosine > 1:
                break
            at = feasible(bucket, unit, focus, cosine)
            at = at[(bucket.label[at] == anchors.label[i]) & (bucket.row[at] != anchors.row[i])]
            score = scores(anchors.whole[i], bucket.whole[at])
            enough = score >= best.least()
            at = at[enough]
            best.add(score[enough], bucket.id[at], bucket.row[at])


def search_negatives(anchors: Anchors, found: list[list[Best]], made: list[Bucket]) -> None:
    for i, (asked, bests) in enumerate(zip(anchors.asked, found, strict=True)):
        if not asked:
            continue
        unit, length, focus = _probe(anchors, i)
        for bucket in made:
            lows = [max(-(-LEAST_PERCENT * p // 100), b.least()) for p, b in zip(asked, bests, strict=True)]
            cosine = _needed(float(min(lows)), length, bucket.longest)
            if cosine > 1:
                break
            at = feasible(bucket, unit, focus, cosine)
            at = at[bucket.label[at] != anchors.label[i]]
            score = scores(anchors.whole[i], bucket.whole[at])
            for low, high, best in zip(lows, asked, bests, strict=True):
                fits = (score >= low) & (score <= high)
                if fits.any():
                    best.add(score[fits], bucket.id[at[fits]], bucket.row[at[fits]])


def _made(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[Bucket]]]:
    for table in runs(batches, ["dim"], 2 * _BUCKET):
        dim = table.column("dim")[0].as_py()
        whole = table.column("whole").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        row, id_, label = (table.column(c).to_numpy() for c in ("row", "id", "label"))
        yield dim, buckets(row, id_, label, whole)


_FOUND = "anchor bigint, place int, row bigint, id bigint, score bigint"


def _told(anchors: dict[int, Anchors], found: dict[int, list[list[Best]]]) -> Iterator[pa.RecordBatch]:
    """What a task found; ``place`` is the anchor's positive that a negative belongs to."""
    for dim, lists in found.items():
        rows = [
            (int(anchors[dim].row[i]), place, int(r), int(d), int(s))
            for i, bests in enumerate(lists)
            for place, best in enumerate(bests)
            for r, d, s in zip(best.row, best.id, best.score, strict=True)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "place", "row", "id", "score"]
        )


def _positives(anchors: dict[int, Anchors], k: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {dim: [Best(k) for _ in block.row] for dim, block in anchors.items()}
        for dim, made in _made(batches):
            if dim in anchors:
                search_positives(anchors[dim], found[dim], made)
        yield from _told(anchors, {dim: [[b] for b in bests] for dim, bests in found.items()})

    return work


def _negatives(anchors: dict[int, Anchors], k: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {dim: [[Best(k) for _ in asked] for asked in block.asked] for dim, block in anchors.items()}
        for dim, made in _made(batches):
            if dim in anchors:
                search_negatives(anchors[dim], found[dim], made)
        yield from _told(anchors, found)

    return work


def _first(found: DataFrame, k: int) -> DataFrame:
    ranked = W.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def _block(table: pa.Table) -> dict[int, Anchors]:
    blocks = {}
    for dim in set(table.column("dim").to_pylist()):
        part = table.filter(pa.compute.equal(table.column("dim"), dim))
        whole = part.column("whole").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        blocks[dim] = Anchors(part.column("row").to_numpy(), part.column("label").to_numpy(), whole)
    return blocks


def mine(
    df: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    anchors: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows of ``is_anchor``. Components become floor(256 x); the score of two rows is their integer inner
    product, which has to fit a long. An anchor's positives are its best other rows of its label; for each of them come
    the best rows of other labels that score from 80 % of the positive's score up to that score. Ties go to the smaller
    id. Rows with a null label, id or vector, an empty vector or a null or non-finite component take no part; rows of
    different dimension are not compared. Rows that repeat an id are rows of their own. An empty table gives an empty
    result.
    """
    spark = df.sparkSession
    ship(spark)
    vec = col(vec_col).cast("array<double>")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = df.filter(vec.isNotNull() & (F.size(vec) > 0) & ~odd & col(label_col).isNotNull() & col(id_col).isNotNull())
    rows = materialize(
        given.select(
            F.monotonically_increasing_id().alias("row"),
            col(id_col).cast("bigint").alias("id"),
            col(label_col).cast("bigint").alias("label"),
            F.size(vec).alias("dim"),
            F.transform(vec, lambda x: F.floor(x * _SCALE)).alias("whole"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        ).withColumn("length", F.aggregate("whole", F.lit(0.0), lambda s, x: s + x.cast("double") * x)),
        "negative-rows",
    )
    asked = rows.filter("is_anchor").select("row", "label", "dim", "whole")
    blocks = max(1, -(-asked.count() // anchors))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    dealt = materialize(
        rows.select("row", "id", "label", "dim", "whole", "length")
        .repartitionByRange("dim", F.desc("length"), "row")
        .sortWithinPartitions("dim", F.desc("length"), "row")
        .drop("length"),
        "negative-buckets",
    )
    results = []
    for number in range(blocks):
        block = _block(asked.filter(F.col("block") == number).drop("block").toArrow())
        best = materialize(_first(dealt.mapInArrow(_positives(block, positives), _FOUND), positives), "positives")
        places: dict[int, list[int]] = {}
        for r in best.select("anchor", "rank", "score").orderBy("anchor", "rank").collect():
            places.setdefault(r.anchor, []).append(r.score)
        block = {
            dim: part._replace(asked=[places.get(int(r), []) for r in part.row]) for dim, part in block.items()
        }
        hard = _first(dealt.mapInArrow(_negatives(block, negatives), _FOUND), negatives)
        results.append(
            materialize(
                hard.select(
                    "anchor",
                    (F.col("place") + 1).alias("of"),
                    "rank",
                    F.col("id").alias("negative_id"),
                    F.col("score").alias("negative_score"),
                ).join(
                    best.select(
                        "anchor",
                        F.col("rank").alias("of"),
                        F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"),
                    ),
                    ["anchor", "of"],
                ),
                "hard-negatives",
            )
        )
    hard = results[0]
    for more in results[1:]:
        hard = hard.unionByName(more)
    names = rows.filter("is_anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return hard.join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def moved_label(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The registered query's labels: every seventh id moves on to the next of ten labels."""
    return F.when(col(id_col) % 7 == 0, (col(label_col) + 1) % 10).otherwise(col(label_col))
