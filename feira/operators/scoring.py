"""Models as data: logistic points and tree ensembles as columns, their loss, the precision-recall curve, alert lists."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.operators.keys import global_rank
from feira.session import materialize

_BINS = 1024


class LogisticPoint(NamedTuple):
    """Coefficients on raw columns: the probability of the positive class is 1 / (1 + exp(-(intercept + sum)))."""

    name: str
    intercept: float
    coefficients: Mapping[str, float]

    def margin(self) -> Column:
        return reduce(lambda a, f: a + F.col(f) * F.lit(self.coefficients[f]), sorted(self.coefficients), F.lit(self.intercept))

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))


def fitted_point(name: str, model: PipelineModel, features: Sequence[str]) -> LogisticPoint:
    """A fitted pipeline of scaler and logistic regression as coefficients on the raw columns."""
    scaler, logistic = model.stages[-2], model.stages[-1]
    factor = [1 / s if s else 0.0 for s in scaler.std]
    raw = {f: float(c) * k for f, c, k in zip(features, logistic.coefficients, factor, strict=True)}
    shift = sum(raw[f] * m for f, m in zip(features, scaler.mean, strict=True))
    return LogisticPoint(name, float(logistic.intercept) - float(shift), raw)


def logistic_loss(table: DataFrame, points: Sequence[LogisticPoint], label: str, weight: Column | None = None) -> DataFrame:
    """(point, loss, gradient) per point in one aggregate: the weighted mean log-loss, and its derivative by the
    intercept ("") and by every feature, as a map.

    At a minimum without penalty the gradient is zero; a constant model only reaches that by the intercept.
    """
    w = F.lit(1.0) if weight is None else weight
    y, total = F.col(label).cast("double"), F.sum(w)
    rows = []
    for point in points:
        z = point.margin()
        loss = w * (F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z))))
        miss = w * (point.probability() - y)
        slopes = [F.lit(""), F.sum(miss) / total]
        for f in sorted(point.coefficients):
            slopes += [F.lit(f), F.sum(miss * F.col(f)) / total]
        rows.append(
            F.struct(F.lit(point.name).alias("point"), (F.sum(loss) / total).alias("loss"), F.create_map(*slopes).alias("gradient"))
        )
    return table.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


class Node(NamedTuple):
    """A node of a tree: a split (rows with ``feature`` <= ``threshold`` go left) or, without a feature, a value."""

    tree: int
    node: int
    feature: str | None
    threshold: float | None
    left: int | None
    right: int | None
    value: float | None


class Ensemble(NamedTuple):
    nodes: tuple[Node, ...]
    weights: tuple[float, ...]


def ensemble_of(model: PipelineModel, features: Sequence[str]) -> Ensemble:
    """The split table of a fitted pipeline of scaler and boosted trees, with thresholds on the raw columns."""
    scaler, boosted = model.stages[-2], model.stages[-1]
    mean, std = list(scaler.mean), list(scaler.std)
    nodes: list[Node] = []

    def walk(tree: int, node, number: int) -> None:
        if node.getClass().getSimpleName() == "LeafNode":
            nodes.append(Node(tree, number, None, None, None, None, float(node.prediction())))
            return
        split = node.split()
        at = split.featureIndex()
        threshold = float(split.threshold()) * std[at] + mean[at]
        nodes.append(Node(tree, number, features[at], threshold, 2 * number, 2 * number + 1, None))
        walk(tree, node.leftChild(), 2 * number)
        walk(tree, node.rightChild(), 2 * number + 1)

    for tree, one in enumerate(boosted.trees):
        walk(tree, one._call_java("rootNode"), 1)
    return Ensemble(tuple(nodes), tuple(boosted.treeWeights))


def compile_trees(ensemble: Ensemble) -> Column:
    """The weighted sum of all trees as nested CASE expressions; scoring stays in generated code."""
    at = {(n.tree, n.node): n for n in ensemble.nodes}

    def column(tree: int, number: int) -> Column:
        n = at[tree, number]
        if n.feature is None:
            return F.lit(n.value)
        return F.when(F.col(n.feature) <= F.lit(n.threshold), column(tree, n.left)).otherwise(column(tree, n.right))

    return reduce(
        lambda a, b: a + b, [column(tree, 1) * F.lit(w) for tree, w in enumerate(ensemble.weights)], F.lit(0.0)
    )


def boosted_probability(ensemble: Ensemble) -> Column:
    """Probability of the positive class of boosted trees with logistic loss."""
    return 1 / (1 + F.exp(-2 * compile_trees(ensemble)))


def pr_curve(scores: DataFrame, score: str, positive: str) -> DataFrame:
    """One row per distinct score, which is the threshold: tp, fp, precision, recall of "score at least this".

    Counts per score are sorted into slices; sums run within a slice on top of those of the slices before it, so no
    task sees the whole curve. Rows without a score or class are left out. Without positives the recall is null.
    """
    good = F.col(positive).cast("int")
    counts = (
        scores.filter(F.col(score).isNotNull() & good.isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(F.sum(good).alias("positives"), F.sum(1 - good).alias("negatives"))
    )
    sliced = materialize(
        counts.orderBy(F.desc("threshold")).withColumn("slice", F.spark_partition_id()), "pr-slices"
    )
    sums = sliced.groupBy("slice").agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n")).collect()
    before, tp, fp = {}, 0, 0
    for row in sorted(sums):
        before[row.slice] = (tp, fp)
        tp, fp = tp + row.p, fp + row.n
    offsets = scores.sparkSession.createDataFrame(
        pa.table(
            {
                "slice": pa.array(list(before), pa.int32()),
                "tp_before": pa.array([b[0] for b in before.values()], pa.int64()),
                "fp_before": pa.array([b[1] for b in before.values()], pa.int64()),
            }
        )
    )
    falling = W.partitionBy("slice").orderBy(F.desc("threshold"))
    summed = sliced.join(F.broadcast(offsets), "slice").select(
        "threshold",
        "positives",
        "negatives",
        (F.col("tp_before") + F.sum("positives").over(falling)).alias("tp"),
        (F.col("fp_before") + F.sum("negatives").over(falling)).alias("fp"),
    )
    return summed.withColumns(
        {"precision": F.col("tp") / (F.col("tp") + F.col("fp")), "recall": F.try_divide(F.col("tp"), F.lit(tp))}
    )


def pr_area(curve: DataFrame) -> DataFrame:
    """(area): trapezoids under the curve, which begins at recall 0 with the precision of the highest score."""
    tp, all_ = F.col("tp") - F.col("positives"), F.col("tp") + F.col("fp") - F.col("positives") - F.col("negatives")
    earlier = F.when(all_ == 0, F.col("precision")).otherwise(F.try_divide(tp, all_))
    step = F.col("recall") * F.try_divide(F.col("positives"), F.col("tp"))
    width = F.when(F.col("positives") == 0, F.lit(0.0)).otherwise(step)
    return curve.agg(F.sum(width * (F.col("precision") + earlier) / 2).alias("area"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """(threshold, f1): where precision and recall are best together, the highest such threshold on ties."""
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    best = curve.withColumn("f1", f1).filter("f1 is not null").agg(F.max(F.struct("f1", "threshold")).alias("best"))
    return best.select("best.threshold", "best.f1")


def top_rows(scores: DataFrame, score: str, ties: Sequence[str], k: int) -> DataFrame:
    """Exactly the ``k`` rows of the highest score (all, if there are fewer), ties by the smallest ``ties``.

    The score of the k-th row is found by counts over ever finer bins, each one aggregate of a written table, so
    nothing is sorted but the rows that tie there, of which a ranked slice completes the list. Rows without a score,
    and scores that are not numbers, are left out.
    """
    kept = materialize(scores.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))), "alert-scores")
    value = F.col(score).cast("double")
    low, high, rows = kept.agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
    if k <= 0:
        return kept.limit(0)
    if rows <= k:
        return kept
    above = 0
    while low < high:
        # The highest value has a bin of its own, so every round narrows the range, however close its ends are.
        width = (high / 2 - low / 2) / _BINS * 2 or math.ulp(0.0)
        number = F.when(value == high, _BINS).otherwise(F.least(F.floor((value - low) / width), F.lit(_BINS - 1)))
        counted = (
            kept.filter(value.between(low, high))
            .groupBy(number.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
            .collect()
        )
        for bin_ in sorted(counted, key=lambda r: -r.low):
            if above + bin_.n >= k:
                break
            above += bin_.n
        low, high = bin_.low, bin_.high
    tied = global_rank(kept.filter(value == low), list(ties), "__place").df.filter(F.col("__place") <= k - above)
    return kept.filter(value > low).unionByName(tied.drop("__place"))

