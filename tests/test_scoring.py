"""Models as columns, their optimum, the precision-recall curve and alert lists."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from feira.operators import churn, scoring
from feira.plans import registry

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        a, b, c = rng.gauss(50, 9), rng.randint(0, 5), 7.0
        rows.append((i, a, float(b), c, float(rng.random() < 1 / (1 + 2.7 ** (-(a - 50) / 6 + b - 2))), 1.0 + i % 3))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, weight double").cache()


def _fit(stage, table):
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
        stage,
    ]
    return Pipeline(stages=stages).fit(table)


def test_the_gradient_vanishes_at_the_optimum_only(people):
    model = _fit(LogisticRegression(labelCol="y", weightCol="weight", maxIter=200, tol=1e-12), people)
    best = scoring.fitted_point("best", model, FEATURES)
    constant = scoring.LogisticPoint("constant", 0.0, dict.fromkeys(FEATURES, 0.0))
    moved = scoring.LogisticPoint("moved", best.intercept, {**best.coefficients, "a": best.coefficients["a"] * 1.1})
    found = {r.point: r for r in scoring.logistic_loss(people, [best, constant, moved], "y", F.col("weight")).collect()}
    assert max(abs(g) for g in found["best"].gradient.values()) < 1e-4
    assert max(abs(g) for g in found["constant"].gradient.values()) > 0.1
    assert max(abs(g) for g in found["moved"].gradient.values()) > 0.1
    assert found["best"].loss < min(found["constant"].loss, found["moved"].loss)
    both = model.transform(people).select(vector_to_array("probability")[1].alias("p"), best.probability().alias("q"))
    assert both.filter(F.abs(F.col("p") - F.col("q")) > 1e-9).count() == 0


def test_compiled_trees_score_as_the_model_does(people):
    model = _fit(GBTClassifier(labelCol="y", weightCol="weight", maxIter=6, maxDepth=4, seed=1), people)
    ensemble = scoring.ensemble_of(model, FEATURES)
    assert len(ensemble.weights) == 6 and sum(n.feature is not None for n in ensemble.nodes) > 12
    scored = model.transform(people).select(
        vector_to_array("probability")[1].alias("p"), scoring.boosted_probability(ensemble).alias("q")
    )
    assert scored.filter(F.abs(F.col("p") - F.col("q")) > 1e-12).count() == 0
    assert scored.select("q").distinct().count() > 20


@pytest.mark.parametrize("distinct", [4, 60, 100_000])
def test_curve_and_area_equal_the_evaluator(spark, distinct):
    rng = random.Random(distinct)
    rows = [(rng.randint(1, distinct) / distinct, rng.random()) for _ in range(900)]
    scores = spark.createDataFrame([(p, int(u < p)) for p, u in rows], "p double, y int").repartition(5)
    curve = scoring.pr_curve(scores, "p", "y").cache()
    assert [r.threshold for r in curve.orderBy(F.desc("threshold")).collect()] == sorted({p for p, _ in rows}, reverse=True)
    for r in curve.collect():
        taken = [u < p for p, u in rows if p >= r.threshold]
        assert (r.tp, r.fp) == (sum(taken), len(taken) - sum(taken))
    judge = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="p", metricName="areaUnderPR", numBins=0)
    assert scoring.pr_area(curve).first().area == pytest.approx(judge.evaluate(scores), abs=1e-9)
    best = scoring.best_threshold(curve).first()
    f1 = {r.threshold: 2 * r.precision * r.recall / (r.precision + r.recall) for r in curve.collect() if r.tp}
    assert best.f1 == pytest.approx(max(f1.values())) and f1[best.threshold] == pytest.approx(best.f1)


def test_curves_of_one_class_and_of_nothing(spark):
    good = spark.createDataFrame([(0.5, 1), (0.5, 1), (0.2, 1), (None, 1), (0.1, None)], "p double, y int")
    curve = scoring.pr_curve(good, "p", "y")
    assert [(r.tp, r.fp, r.precision, r.recall) for r in curve.orderBy("recall").collect()] == [
        (2, 0, 1.0, pytest.approx(2 / 3)),
        (3, 0, 1.0, 1.0),
    ]
    assert scoring.pr_area(curve).first().area == pytest.approx(1.0)
    bad = scoring.pr_curve(spark.createDataFrame([(0.5, 0), (0.2, 0)], "p double, y int"), "p", "y")
    assert {(r.precision, r.recall) for r in bad.collect()} == {(0.0, None)}
    assert scoring.best_threshold(bad).first().threshold is None
    empty = scoring.pr_curve(good.limit(0), "p", "y")
    assert empty.count() == 0 and scoring.pr_area(empty).first().area is None


@pytest.mark.parametrize("k", [0, 1, 7, 100, 499, 500, 501, 2000])
def test_exactly_k_rows_with_ties_by_id(spark, k):
    rng = random.Random(5)
    rows = [(f"{i:04d}", rng.choice([0.5, 0.5 + 1e-16 * 3, 0.25, rng.random(), 1e300, -1e300])) for i in range(500)]
    df = spark.createDataFrame([*rows, ("x", None), ("y", float("nan"))], "id string, s double").repartition(3)
    found = sorted((r.id, r.s) for r in scoring.top_rows(df, "s", ["id"], k).collect())
    assert found == sorted(sorted(rows, key=lambda r: (-r[1], r[0]))[:k])


@pytest.mark.parametrize("name, kind", [("churn_scores", "logistic"), ("churn_scores_boosted", "boosted")])
def test_registered_scores_fit_their_model_and_score_everybody(spark, monkeypatch, name, kind):
    rng = random.Random(11)
    rows = [
        (f"u{i}", int(rng.random() < (0.9 if i % 2 else 0.2)), *map(float, (10 + i % 2 * 90 + i % 7, 1 + i % 5, 2 * i, 0.5, 0.1, 3, i % 4)))
        for i in range(300)
    ]
    table = spark.createDataFrame(rows, f"customer_unique_id string, churned int, {', '.join(f'{f} double' for f in churn.FEATURES)}")
    fitted = []

    def model(*args):
        fitted.append(args[-1])
        return churn.train_logistic(table) if kind == "logistic" else churn.train_boosted(table, rounds=2, depth=2)

    monkeypatch.setattr(registry, "_training", lambda *_: table)
    monkeypatch.setattr(registry, "_model", model)
    found = registry.QUERIES[name](spark, "own rows").collect()
    assert fitted == [kind]
    assert sorted(r.customer_unique_id for r in found) == sorted(r[0] for r in rows)
    assert all(r.is_probability and 0 <= r.churn_probability <= 1 for r in found)
