"""Customer features, churn label, models and the retention alert list."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.dates import date_of_key
from feira.operators.clean import DEFAULT_REVIEW_SCORE
from feira.operators.logistics import delay_days
from feira.operators.star import latest_review_per_order
from feira.session import materialize

FEATURES = (
    "recency_days",
    "frequency",
    "monetary",
    "delivery_delay_days",
    "freight_ratio",
    "avg_review_score",
    "max_installments",
)


def _by_person(per_key: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Rows of customers that no dimension row knows go to the person NULL."""
    return per_key.join(dim_customers.select("customer_key", "customer_unique_id"), "customer_key", "left")


def rfm(fact: DataFrame, dim_customers: DataFrame, analysis_date: str) -> DataFrame:
    """Recency against ``analysis_date``, number of orders and money spent, per person.

    Items are first summed to orders, so frequency is a plain count and a busy customer is spread over its orders.
    """
    per_order = fact.groupBy("customer_key", "order_id").agg(
        F.max("order_date_key").alias("order_date_key"), F.sum("item_price").alias("value")
    )
    per_key = per_order.groupBy("customer_key").agg(
        F.max("order_date_key").alias("last_key"),
        F.count("*").alias("frequency"),
        F.sum("value").alias("monetary"),
    )
    recency = F.datediff(F.lit(analysis_date).cast("date"), date_of_key(F.max("last_key")))
    return (
        _by_person(per_key, dim_customers)
        .groupBy("customer_unique_id")
        .agg(
            recency.alias("recency_days"),
            F.sum("frequency").alias("frequency"),
            F.sum("monetary").cast("double").alias("monetary"),
        )
    )


def friction(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Mean delivery delay and freight as a share of the price, per person."""
    per_key = fact.groupBy("customer_key").agg(
        F.sum(delay_days()).alias("delay"),
        F.count(delay_days()).alias("delivered"),
        F.sum("freight_value").alias("freight"),
        F.sum("item_price").alias("price"),
    )
    return (
        _by_person(per_key, dim_customers)
        .groupBy("customer_unique_id")
        .agg(
            F.try_divide(F.sum("delay"), F.sum("delivered")).alias("delivery_delay_days"),
            F.try_divide(F.sum("freight").cast("double"), F.sum("price").cast("double")).alias("freight_ratio"),
        )
    )


def experience(fact: DataFrame, payments: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Mean review score over items and the largest number of instalments, per person."""
    per_order = fact.groupBy("customer_key", "order_id").agg(
        F.sum("review_score").alias("score"), F.count("*").alias("items")
    )
    instalments = payments.groupBy("order_id").agg(F.max("payment_installments").alias("instalments"))
    per_key = (
        per_order.join(instalments, "order_id", "left")
        .groupBy("customer_key")
        .agg(
            F.sum("score").alias("score"),
            F.sum("items").alias("items"),
            F.max("instalments").alias("instalments"),
        )
    )
    return (
        _by_person(per_key, dim_customers)
        .groupBy("customer_unique_id")
        .agg(
            F.try_divide(F.sum("score"), F.sum("items")).alias("avg_review_score"),
            F.max("instalments").alias("max_installments"),
        )
    )


def churn_label(orders: DataFrame, dim_customers: DataFrame, cutoff: str, horizon_days: int = 180) -> DataFrame:
    """1 for people who bought before ``cutoff`` and not within ``horizon_days`` after it, else 0.

    Features must come from before the cut-off: a label made from the same orders as the frequency feature would
    leak it.
    """
    bought, start = F.col("order_purchase_timestamp"), F.lit(cutoff).cast("timestamp")
    end = F.date_add(F.lit(cutoff).cast("date"), horizon_days).cast("timestamp")
    per_account = orders.groupBy("customer_id").agg(
        F.count_if(bought < start).alias("before"),
        F.count_if((bought >= start) & (bought < end)).alias("after"),
    )
    return (
        per_account.join(dim_customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
        .groupBy("customer_unique_id")
        .agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
        .filter(F.col("before") > 0)
        .select("customer_unique_id", F.when(F.col("after") == 0, 1).otherwise(0).alias("churned"))
    )


def before_cutoff(fact: DataFrame, reviews: DataFrame, cutoff: str) -> DataFrame:
    """The fact as it was known at ``cutoff``: orders bought before it, deliveries and reviews dated before it.

    The cut-off is compared as an integer date key, so it reaches the scan of the fact.
    """
    key = int(cutoff.replace("-", ""))
    known = latest_review_per_order(
        reviews.filter(F.col("review_answer_timestamp") < F.lit(cutoff).cast("timestamp"))
    ).select("order_id", F.col("review_score").alias("known_score"))
    delivered = F.when(F.col("delivered_date_key") < key, F.col("delivered_date_key"))
    return (
        fact.filter(F.col("order_date_key") < key)
        .withColumn("delivered_date_key", delivered)
        .join(known, "order_id", "left")
        .withColumn("review_score", F.coalesce("known_score", F.lit(DEFAULT_REVIEW_SCORE)))
        .drop("known_score")
    )


def customer_features(
    fact: DataFrame, payments: DataFrame, dim_customers: DataFrame, analysis_date: str
) -> DataFrame:
    """Recency, frequency, money, friction and experience per person in one pass over the fact.

    Items are summed to orders, orders to customers and customers to persons, each on its way to the next key.
    """
    per_order = fact.groupBy("customer_key", "order_id").agg(
        F.max("order_date_key").alias("last_key"),
        F.sum("item_price").alias("price"),
        F.sum("freight_value").alias("freight"),
        F.sum(delay_days()).alias("delay"),
        F.count(delay_days()).alias("delivered"),
        F.sum("review_score").alias("score"),
        F.count("*").alias("items"),
    )
    instalments = payments.groupBy("order_id").agg(F.max("payment_installments").alias("instalments"))
    sums = ("price", "freight", "delay", "delivered", "score", "items")
    per_key = (
        per_order.join(instalments, "order_id", "left")
        .groupBy("customer_key")
        .agg(
            F.max("last_key").alias("last_key"),
            F.count("*").alias("orders"),
            F.max("instalments").alias("instalments"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    recency = F.datediff(F.lit(analysis_date).cast("date"), date_of_key(F.max("last_key")))
    return (
        _by_person(per_key, dim_customers)
        .groupBy("customer_unique_id")
        .agg(
            recency.alias("recency_days"),
            F.sum("orders").alias("frequency"),
            F.sum("price").cast("double").alias("monetary"),
            F.try_divide(F.sum("delay"), F.sum("delivered")).alias("delivery_delay_days"),
            F.try_divide(F.sum("freight").cast("double"), F.sum("price").cast("double")).alias("freight_ratio"),
            F.try_divide(F.sum("score"), F.sum("items")).alias("avg_review_score"),
            F.max("instalments").alias("max_installments"),
        )
    )


def training_table(
    fact: DataFrame,
    payments: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    dim_customers: DataFrame,
    cutoff: str,
    horizon_days: int = 180,
) -> DataFrame:
    """Features from before the cut-off beside the label from after it; people only, not the NULL person."""
    features = customer_features(before_cutoff(fact, reviews, cutoff), payments, dim_customers, cutoff)
    return (
        churn_label(orders, dim_customers, cutoff, horizon_days)
        .join(features, "customer_unique_id")
        .fillna(0.0, list(FEATURES))
    )


class ChurnModel(NamedTuple):
    """A model and its figures on the held-back people: area under the precision-recall curve of the loyal class
    (classes weighted equally, so chance is ``CHANCE``), and the share of loyal people it finds."""

    model: PipelineModel
    features: tuple[str, ...]
    pr_auc: float
    loyal_recall: float
    degenerate: bool


CHANCE = 0.5
HELD_BACK = 5


def is_held_back(seed: int = 7) -> Column:
    """A fifth of the people, by a hash of their id; the same for every model, and never used to choose one."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("customer_unique_id"))), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % HELD_BACK == 0


def with_weights(table: DataFrame) -> DataFrame:
    """The positive class is ``loyal``, the one campaigns look for; both classes get equal total weight."""
    counts = table.agg(F.count("*").alias("n"), F.sum("churned").alias("churned")).first()
    n, churned = counts["n"], counts["churned"] or 0
    loyal = n - churned
    weight = F.when(F.col("churned") == 1, n / (2 * max(churned, 1))).otherwise(n / (2 * max(loyal, 1)))
    return table.withColumns({"loyal": (1 - F.col("churned")).cast("double"), "weight": weight})


def _prepare(features: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(features), outputCol="assembled", handleInvalid="error"),
        StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
    ]


def standardised(table: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The feature vector with mean 0 and deviation 1, as one column per feature."""
    scaled = Pipeline(stages=_prepare(features)).fit(table).transform(table)
    values = scaled.select("customer_unique_id", vector_to_array("features").alias("v"))
    return values.select("customer_unique_id", *[F.col("v")[i].alias(f) for i, f in enumerate(features)])


def _pr_auc() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        labelCol="loyal", rawPredictionCol="rawPrediction", metricName="areaUnderPR", weightCol="weight"
    )


def _split(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training people and held-back people, each with weights of their own."""
    used = materialize(with_weights(table.filter(~is_held_back())), "churn-training")
    return used, materialize(with_weights(table.filter(is_held_back())), "churn-test")


def _measured(model: PipelineModel, features: tuple[str, ...], test: DataFrame, fold_score: float) -> ChurnModel:
    scored = model.transform(test)
    loyal = scored.filter("loyal = 1").agg(F.count("*").alias("n"), F.count_if(F.col("prediction") == 1).alias("found"))
    n, found = loyal.first()
    constant = scored.select(vector_to_array("probability")[1].alias("p")).agg(F.max("p") - F.min("p")).first()[0]
    separates = fold_score > CHANCE and (constant or 0.0) > 0.0
    auc = _pr_auc().evaluate(scored) if n else 0.0
    return ChurnModel(model, features, auc, found / n if n else 0.0, not separates)


def train_logistic(
    table: DataFrame,
    features: Sequence[str] = FEATURES,
    top: int = 4,
    reg_params: Sequence[float] = (0.0, 0.1),
    elastic_net_params: Sequence[float] = (0.0, 0.5),
    folds: int = 2,
    seed: int = 7,
) -> ChurnModel:
    """Grid-searched logistic regression on the ``top`` features by standardised coefficient.

    Features and grid are chosen by folds of the training people; the figures come from the held-back ones. Among grid
    points whose fold scores tie to three digits the least regularised wins, so a constant model is chosen only if
    there is no other; ``degenerate`` says that nothing separated better than chance.
    """
    used, test = _split(table)
    first = LogisticRegression(labelCol="loyal", weightCol="weight", maxIter=20)
    screening = Pipeline(stages=[*_prepare(features), first]).fit(used)
    sizes = [abs(c) for c in screening.stages[-1].coefficients]
    chosen = tuple(f for _, f in sorted(zip(sizes, features), reverse=True)[:top])
    logistic = LogisticRegression(labelCol="loyal", weightCol="weight", maxIter=50, threshold=0.5)
    grid = (
        ParamGridBuilder()
        .addGrid(logistic.regParam, list(reg_params))
        .addGrid(logistic.elasticNetParam, list(elastic_net_params))
        .build()
    )
    whole = Pipeline(stages=[*_prepare(chosen), logistic])
    search = CrossValidator(
        estimator=whole, estimatorParamMaps=grid, evaluator=_pr_auc(), numFolds=folds, seed=seed, parallelism=2
    ).fit(used)

    def rank(place: int) -> tuple[float, float, float]:
        point = grid[place]
        # A fold score at or below chance is no separation, however it compares with others of that kind.
        score = max(CHANCE, round(search.avgMetrics[place], 3))
        return -score, point[logistic.regParam], point[logistic.elasticNetParam]

    best = min(range(len(grid)), key=rank)
    return _measured(whole.copy(grid[best]).fit(used), chosen, test, search.avgMetrics[best])


def train_boosted(
    table: DataFrame, features: Sequence[str] = FEATURES, rounds: int = 10, depth: int = 3, seed: int = 7
) -> ChurnModel:
    """Gradient-boosted trees with class weights, measured on the held-back people."""
    used, test = _split(table)
    trees = GBTClassifier(labelCol="loyal", weightCol="weight", maxIter=rounds, maxDepth=depth, seed=seed)
    model = Pipeline(stages=[*_prepare(features), trees]).fit(used)
    found = _measured(model, tuple(features), test, 1.0)
    return found._replace(degenerate=found.degenerate or found.pr_auc <= CHANCE)


def score(table: DataFrame, trained: ChurnModel, carried: Sequence[str] = ()) -> DataFrame:
    """Churn probability of every person in ``table``, beside the ``carried`` columns."""
    scored = trained.model.transform(table)
    churn = 1.0 - vector_to_array("probability")[1]
    return scored.select("customer_unique_id", churn.alias("churn_probability"), *carried)


def alerts(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """People whose churn probability is above the threshold."""
    return scores.filter(F.col("churn_probability") > threshold)
