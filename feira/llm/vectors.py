"""Embedding near-duplicates: links at a cosine of ``COSINE`` or more, found by counting collisions of projections.

Every vector is projected on many random directions. Each direction is one sorted list, of which only the tails (beyond
``threshold`` standard deviations) are kept: there lists are short, while two close vectors still meet. Around each
value lies a window; two vectors whose values fall into each other's window collide. Pairs with at least ``COUNT``
collisions are verified exactly. The number of directions follows from the wanted recall of a pair right at the
limit, whose number of collisions is binomial; the tail grows rarer with the square root of the table, so that both the
projections and the collisions of strangers grow with its power of 1.5 and not with its square.

Groups of many near copies would collide in all pairs, so vectors are first gathered into balls of half the limit
angle: all members of a ball are linked with each other by the triangle inequality. In each list a ball is one interval
from its members' smallest to their largest value, which keeps every collision of any member. Two balls that collide
often enough are linked whole, or not at all, where their centres and radii prove it; else their members are compared
exactly, in cells of bounded size, and only counts leave the cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.llm.common import col, fresh, ship
from feira.llm.components import components
from feira.session import materialize

COSINE = 0.9
#: Wanted share of found pairs among those right at the limit; closer pairs are found more often.
RECALL = 0.9998
#: Collisions that a pair needs before it is verified.
COUNT = 2
#: Half width of a window, in standard deviations of a projection.
WINDOW = 1.0
SEED = 20240611
#: Share of a list that is kept at each end, times the square root of the number of vectors.
_TAIL = 0.036
_CODES = 256
_CHUNK = 1024
_ROWS = 1024
_DIRECTIONS = 4096
#: Angles that decide without a comparison keep this distance from the limit.
_MARGIN = 1e-7


class Plan(NamedTuple):
    threshold: float
    directions: int
    count: int
    recall: float


def collision_chance(cosine: float, threshold: float, window: float = WINDOW) -> float:
    """Chance that two unit vectors of this cosine collide in one random direction (either tail)."""
    spread = math.sqrt(1 - cosine * cosine)
    g = np.linspace(threshold, threshold + 8, 8001)
    density = np.exp(-g * g / 2) / math.sqrt(2 * math.pi)
    below = np.vectorize(NormalDist().cdf)
    met = below((g + window - cosine * g) / spread) - below((np.maximum(threshold, g - window) - cosine * g) / spread)
    return float(2 * np.trapezoid(density * met, g))


def recall_of(directions: int, chance: float, count: int) -> float:
    """Chance of at least ``count`` collisions in so many independent directions."""
    missed = 0.0
    for k in range(count):
        ways = math.lgamma(directions + 1) - math.lgamma(k + 1) - math.lgamma(directions - k + 1)
        missed += math.exp(ways + k * math.log(chance) + (directions - k) * math.log1p(-chance))
    return 1 - missed


def calibrate(rows: int, cosine: float = COSINE, recall: float = RECALL, count: int = COUNT) -> Plan:
    """Tail threshold for a table of ``rows`` vectors, and the fewest directions that reach the recall at the limit."""
    threshold = -NormalDist().inv_cdf(min(0.005, _TAIL / math.sqrt(max(rows, 1))))
    chance = collision_chance(cosine, threshold)
    low, high = count, count + 1
    while recall_of(high, chance, count) < recall:
        low, high = high, high * 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if recall_of(middle, chance, count) >= recall else (middle, high)
    return Plan(threshold, high, count, recall_of(high, chance, count))


def usable(vector: Column) -> Column:
    """Whether a vector can be linked: not null, not all zero, no component null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, dim = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, dim), pa.int32()), pa.array(matrix.ravel()))


def directions(dim: int, block: int, n: int) -> np.ndarray:
    """``n`` random directions (columns) of a numbered block; the same in every task."""
    return np.random.Generator(np.random.PCG64([SEED, dim, block])).standard_normal((dim, n), dtype=np.float32)


def _codes(unit: np.ndarray) -> np.ndarray:
    """The direction of a small bank that lies closest: near copies mostly share it."""
    return np.argmax(unit.astype(np.float32) @ directions(unit.shape[1], 1 << 30, _CODES), axis=1).astype(np.int32)


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "id", "dim", "code", "unit"]
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            x = _matrix(part.column("vec"), int(dim))
            # Scaled first, so that squares neither overflow nor vanish.
            x = x / np.abs(x).max(axis=1, keepdims=True)
            unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            columns = [part.column("row"), part.column("id"), part.column("dim"), pa.array(_codes(unit)), _lists(unit)]
            yield pa.RecordBatch.from_arrays(columns, names)


def runs(batches: Iterable[pa.RecordBatch], names: list[str], most: int | None) -> Iterator[pa.Table]:
    """Sorted rows as one table per value of ``names``; runs longer than ``most`` come in several tables."""
    held: list[pa.RecordBatch] = []
    size, key = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in names])
        changed = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        bounds = [0, *changed.tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            here = tuple(keys[:, a])
            if held and here != key:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            key = here
            while most and size + b - a >= most:
                held.append(batch.slice(a, most - size))
                yield pa.Table.from_batches(held)
                a, held, size = a + most - size, [], 0
            if b > a:
                held.append(batch.slice(a, b - a))
                size += b - a
    if held:
        yield pa.Table.from_batches(held)


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b, -1.0, 1.0))


def gather(unit: np.ndarray, radius: np.ndarray, most: float) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, float]]]:
    """Greedy balls of angle ``most`` over points that are balls themselves (``radius``; zero for vectors).

    Returns the first point of each point's ball, and centre and radius of the balls of more than one point. A centre is
    the mean direction where that covers all members, else the first point.
    """
    n = len(unit)
    near = unit.astype(np.float32) @ unit.astype(np.float32).T > math.cos(most) - 1e-5
    first = np.full(n, -1)
    balls: dict[int, tuple[np.ndarray, float]] = {}
    for i in range(n):
        if first[i] >= 0:
            continue
        first[i] = i
        others = np.flatnonzero(near[i])
        others = others[first[others] < 0]
        if len(others):
            others = others[_angles(unit[others], unit[i]) + radius[others] <= most]
        if radius[i] > most or not len(others):
            continue
        members = np.append(i, others)
        first[members] = i
        mean = unit[members].sum(axis=0)
        mean /= math.sqrt(mean @ mean)
        reach = float((_angles(unit[members], mean) + radius[members]).max()) + _MARGIN
        if reach <= most:
            balls[i] = mean, reach
        else:
            balls[i] = unit[i], float((_angles(unit[members], unit[i]) + radius[members]).max())
    return first, balls


def _balls(most: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ball of every row; the first row of a ball of several carries its centre, radius and size."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["dim", "code"], _CHUNK):
            dim = table.column("dim")[0].as_py()
            unit = _matrix(table.column("unit").combine_chunks(), dim)
            first, balls = gather(unit, np.zeros(len(unit)), most)
            rows = table.column("row").to_numpy()
            sizes = np.bincount(first, minlength=len(first))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows),
                    pa.array(rows[first]),
                    pa.array([balls[i][0].tolist() if i in balls else None for i in range(len(rows))], pa.list_(pa.float64())),
                    pa.array([balls[i][1] if i in balls else None for i in range(len(rows))], pa.float64()),
                    pa.array(np.where(first == np.arange(len(first)), sizes, 0), pa.int64()),
                    table.column("dim").combine_chunks(),
                ],
                ["row", "ball", "centre", "radius", "size", "dim"],
            )

    return work


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            codes = pa.array(_codes(_matrix(part.column("centre"), int(dim))))
            yield pa.RecordBatch.from_arrays([*part.columns, codes], [*part.schema.names, "code"])


def _merged(most: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Balls of several, joined where one ball of the allowed radius covers them."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["dim", "code"], _CHUNK):
            dim = table.column("dim")[0].as_py()
            centre = _matrix(table.column("centre").combine_chunks(), dim).copy()
            radius, size = table.column("radius").to_numpy().copy(), table.column("size").to_numpy()
            first, balls = gather(centre, radius, most)
            total = np.zeros(len(first), np.int64)
            np.add.at(total, first, size)
            names = table.column("ball").to_numpy()
            for i, (c, r) in balls.items():
                centre[i], radius[i] = c, r
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names),
                    pa.array(names[first]),
                    _lists(centre[first]),
                    pa.array(radius[first]),
                    pa.array(total[first]),
                    table.column("dim").combine_chunks(),
                ],
                ["old", "ball", "centre", "radius", "size", "dim"],
            )

    return work


def _balls_of(units: DataFrame, most: float) -> tuple[DataFrame, DataFrame]:
    """(row, ball) of every vector, and (ball, centre, radius, size, dim) of the balls of several."""
    shape = "ball bigint, centre array<double>, radius double, size bigint, dim int"
    rows = materialize(
        units.select("row", "dim", "code", "unit")
        .repartitionByRange("dim", "code", "row")
        .sortWithinPartitions("dim", "code", "row")
        .mapInArrow(_balls(most), f"row bigint, {shape}"),
        "vector-balls",
    )
    of, balls = rows.select("row", "ball"), rows.filter("size > 1").drop("row")
    many = balls.count()
    while many > 1:
        moved = materialize(
            balls.mapInArrow(_coded, f"{shape}, code int")
            .repartitionByRange("dim", "code", "ball")
            .sortWithinPartitions("dim", "code", F.desc("size"), "ball")
            .mapInArrow(_merged(most), f"old bigint, {shape}"),
            "vector-merged",
        )
        left = moved.filter("old = ball").count()
        if left == many:
            break
        names = moved.filter("old <> ball").select("old", F.col("ball").alias("new"))
        of = of.join(names, of["ball"] == names["old"], "left").select("row", F.coalesce("new", "ball").alias("ball"))
        balls, many = moved.filter("old = ball").drop("old"), left
    return of, balls


def _tails(plan: Plan) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Intervals (dim, list, ball, low, high) of the values beyond the threshold; a list is a direction and a sign."""

    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        dim = rows.column("dim")[0].as_py()
        unit = _matrix(rows.column("unit").combine_chunks(), dim).astype(np.float32)
        ball = rows.column("ball").to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for block in range(-(-plan.directions // _DIRECTIONS)):
            wide = min(_DIRECTIONS, plan.directions - block * _DIRECTIONS)
            values = unit @ directions(dim, block, _DIRECTIONS)[:, :wide]
            at = np.flatnonzero(np.abs(values) > np.float32(plan.threshold))
            value = values.ravel()[at]
            where = 2 * (block * _DIRECTIONS + at % wide) + (value < 0)
            found.append((where, ball[at // wide], value))
        where, owner, value = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(where):
            return
        order = np.lexsort((owner, where))
        where, owner, value = where[order], owner[order], value[order]
        start = np.flatnonzero(np.append(True, (where[1:] != where[:-1]) | (owner[1:] != owner[:-1])))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(start), dim, np.int32)),
                pa.array(where[start].astype(np.int64)),
                pa.array(owner[start]),
                pa.array(np.minimum.reduceat(value, start)),
                pa.array(np.maximum.reduceat(value, start)),
            ],
            ["dim", "list", "ball", "low", "high"],
        )

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["dim"], _ROWS):
            yield from solve(rows)

    return work


def _decide(cosine: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidate pairs of balls: linked whole (true) or undecided (null); pairs without any link are left out."""
    limit = math.acos(cosine)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                left, right = (_matrix(part.column(c), int(dim)) for c in ("left_centre", "right_centre"))
                close = (left * right).sum(axis=1)
                reach = part.column("left_radius").to_numpy() + part.column("right_radius").to_numpy()
                angle = np.arccos(np.clip(close, -1.0, 1.0))
                whole = np.where(reach == 0, close >= cosine, angle + reach <= limit - _MARGIN)
                none = np.where(reach == 0, close < cosine, angle - reach > limit + _MARGIN)
                keep = pa.array(~none)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).filter(keep) for c in ("a", "b", "left_size", "right_size")]
                    + [pa.array(whole).filter(keep)],
                    ["a", "b", "left_size", "right_size", "whole"],
                )

    return work


def _compared(cosine: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links per row within one cell: the members of a chunk of one ball against a chunk of another."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["a", "b", "i", "j"], None):
            dim = cell.column("dim")[0].as_py()
            unit = _matrix(cell.column("unit").combine_chunks(), dim)
            side, rows = cell.column("side").to_numpy(), cell.column("row").to_numpy()
            linked = unit[side == 0] @ unit[side == 1].T >= cosine
            n = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
            rows = np.concatenate([rows[side == 0], rows[side == 1]])
            a, b = cell.column("a")[0].as_py(), cell.column("b")[0].as_py()
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(met), a, np.int64)),
                    pa.array(np.full(len(met), b, np.int64)),
                    pa.array(rows[met]),
                    pa.array(n[met].astype(np.int64)),
                ],
                ["a", "b", "row", "n"],
            )

    return work


def _member_links(undecided: DataFrame, members: DataFrame, cosine: float) -> DataFrame:
    """(a, b, row, n): links of the members of undecided pairs of balls, by exact comparison."""

    def chunks(size: str) -> Column:
        return F.ceil(F.col(size) / _CHUNK).cast("int")

    cells = undecided.select(
        "a", "b", F.explode(F.sequence(F.lit(0), chunks("left_size") - 1)).alias("i"), chunks("right_size").alias("of")
    ).select("a", "b", "i", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("j"))
    cells = materialize(cells, "vector-cells")
    chunked = members.withColumn("chunk", F.pmod(F.xxhash64("row"), chunks("size")).cast("int"))
    sides = [
        cells.join(chunked, (F.col("ball") == F.col(ball)) & (F.col("chunk") == F.col(place))).select(
            "a", "b", "i", "j", F.lit(side).alias("side"), "row", "dim", "unit"
        )
        for side, ball, place in ((0, "a", "i"), (1, "b", "j"))
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .repartition("a", "b", "i", "j")
        .sortWithinPartitions("a", "b", "i", "j", "side", "row")
        .mapInArrow(_compared(cosine), "a bigint, b bigint, row bigint, n bigint")
    )


def candidates(members: DataFrame, plan: Plan) -> DataFrame:
    """(a, b, n): pairs of balls with enough collisions in the sorted lists."""
    tails = materialize(
        members.select("dim", "ball", "unit")
        .mapInArrow(_tails(plan), "dim int, list bigint, ball bigint, low float, high float")
        .groupBy("dim", "list", "ball")
        .agg(F.min("low").alias("low"), F.max("high").alias("high")),
        "vector-tails",
    )
    left = tails.select("dim", "list", F.col("ball").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    right = tails.select("dim", "list", F.col("ball").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    window = (F.col("low_b") <= F.col("high_a") + WINDOW) & (F.col("low_a") <= F.col("high_b") + WINDOW)
    return (
        left.join(right, ["dim", "list"])
        .filter((F.col("a") < F.col("b")) & window)
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= plan.count)
    )


def link_groups(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    cosine: float = COSINE,
    recall: float = RECALL,
) -> DataFrame:
    """One row per input row: id, n_links, component_id (smallest id reachable), kept (id = component_id).

    Null, empty and zero vectors and those with a null or non-finite component link with nothing; vectors of different
    lengths do not link with each other. Rows that repeat an id or a vector are rows of their own, linked like any
    other. A null id counts as larger than all others and is not kept. An empty table gives an empty result. Every
    link that is counted was verified in double precision or follows from the triangle inequality; a pair right at the
    limit is found with probability ``recall``.
    """
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    ship(df.sparkSession)
    kind = df.select(col(id_col)).schema[0].dataType.simpleString()
    vec = col(vec_col).cast("array<double>")
    rows = materialize(
        df.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), vec.alias("vec")).select(
            "row", "id", F.when(usable(F.col("vec")), F.col("vec")).alias("vec")
        ),
        "vectors",
    )
    units = materialize(
        rows.filter("vec is not null")
        .select("row", "id", F.size("vec").alias("dim"), "vec")
        .mapInArrow(_units, f"row bigint, id {kind}, dim int, code int, unit array<double>"),
        "vector-units",
    )
    of, balls = _balls_of(units, math.acos(cosine) / 2)
    plan = calibrate(units.count(), cosine, recall)
    large = balls.select("ball", "centre", "radius", "size")
    members = materialize(
        units.join(of, "row")
        .join(large.select("ball", "size"), "ball", "left")
        .select("row", "id", "dim", "unit", "ball", F.coalesce("size", F.lit(1)).alias("size")),
        "vector-members",
    )
    found = materialize(candidates(members, plan), "vector-candidates")
    single = members.filter("size = 1").select(
        "ball", F.col("unit").alias("centre"), F.lit(0.0).alias("radius"), "size"
    )
    every = materialize(single.unionByName(large), "vector-centres")
    sides = [
        every.select(
            F.col("ball").alias(name), *[F.col(c).alias(f"{side}_{c}") for c in ("centre", "radius", "size")]
        )
        for name, side in (("a", "left"), ("b", "right"))
    ]
    decided = materialize(
        found.join(sides[0], "a")
        .join(sides[1], "b")
        .withColumn("dim", F.size("left_centre"))
        .mapInArrow(_decide(cosine), "a bigint, b bigint, left_size bigint, right_size bigint, whole boolean"),
        "vector-decided",
    )
    whole = decided.filter("whole")
    partly = materialize(_member_links(decided.filter("not whole"), members, cosine), "vector-links")
    per_ball = (
        whole.select(F.col("a").alias("ball"), F.col("right_size").alias("n"))
        .unionByName(whole.select(F.col("b").alias("ball"), F.col("left_size").alias("n")))
        .groupBy("ball")
        .agg(F.sum("n").alias("by_ball"))
    )
    per_row = partly.groupBy("row").agg(F.sum("n").alias("by_row"))
    edges = whole.select("a", "b").unionByName(partly.select("a", "b"))
    named = components(edges, "vector-components").select(F.col("node").alias("ball"), F.col("component").alias("part"))
    labelled = materialize(
        members.select("row", "id", "ball", "size")
        .join(per_ball, "ball", "left")
        .join(per_row, "row", "left")
        .join(named, "ball", "left")
        .select(
            "row",
            "id",
            F.coalesce("part", "ball").alias("part"),
            (F.col("size") - 1 + F.coalesce("by_ball", F.lit(0)) + F.coalesce("by_row", F.lit(0))).alias("n_links"),
        ),
        "vector-labels",
    )
    smallest = labelled.groupBy("part").agg(F.min("id").alias("component_id"))
    linked = labelled.join(smallest, "part").select("id", "n_links", "component_id")
    alone = rows.filter("vec is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def near_dedup(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """The rows whose id names their component, with all their columns; rows with a null id stay.

    Rows that share an id are kept or dropped together.
    """
    groups = link_groups(df, id_col, vec_col, cosine)
    gone = fresh(df, "__gone")
    losers = materialize(
        groups.filter(col(id_col).isNotNull())
        .groupBy(col(id_col).alias(gone))
        .agg(F.max("kept").alias("kept"))
        .filter("not kept")
        .select(gone),
        "vector-losers",
    )
    return df.join(losers, col(id_col) == F.col(gone), "left_anti")
