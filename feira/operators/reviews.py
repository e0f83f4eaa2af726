"""Review questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.functions.text import mentions
from feira.operators.groups import share_of_total
from feira.operators.logistics import delay_days

NEGATIVE_SCORES = (1, 3)


def score_distribution(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("review_score").agg(F.count("*").alias("items"))
    return share_of_total(counted, {"items": "share"})


def _delays(fact: DataFrame) -> DataFrame:
    return fact.select("review_score", delay_days().alias("delay_days")).filter(F.col("delay_days").isNotNull())


def score_vs_delay(fact: DataFrame) -> DataFrame:
    """Mean delay and late share per score."""
    return (
        _delays(fact)
        .groupBy("review_score")
        .agg(
            F.count("*").alias("items"),
            F.avg("delay_days").alias("avg_delay_days"),
            (F.count_if(F.col("delay_days") > 0) / F.count("*")).alias("late_share"),
        )
    )


def score_delay_correlation(fact: DataFrame) -> DataFrame:
    return _delays(fact).agg(
        F.count("*").alias("items"), F.corr("review_score", "delay_days").alias("correlation")
    )


def negative_words(reviews: DataFrame, scores: tuple[int, int] = NEGATIVE_SCORES) -> DataFrame:
    """How often every word occurs in the cleaned comments of badly scored reviews."""
    words = reviews.filter(F.col("review_score").between(*scores)).select(
        F.explode(F.split("review_comment_cleaned", " ")).alias("word")
    )
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count("*").alias("occurrences"))


def keyword_mentions(reviews: DataFrame, phrases: Sequence[str]) -> DataFrame:
    """Per score: reviews with a comment, and how many mention each phrase."""
    found = [F.struct(F.lit(p).alias("phrase"), mentions("review_comment_cleaned", p).alias("found")) for p in phrases]
    commented = reviews.filter(F.col("review_comment_cleaned").isNotNull())
    return (
        commented.select("review_score", F.inline(F.array(*found)))
        .groupBy("review_score", "phrase")
        .agg(F.count("*").alias("comments"), F.count_if("found").alias("mentions"))
    )
