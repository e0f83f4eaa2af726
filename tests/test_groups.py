import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from feira.operators.groups import any_per_key, discrete_quantile, first_per_key, share_of_total

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def medians(spark, rows):
    df = spark.createDataFrame(rows, "g string, v int")
    return {r["g"]: r["m"] for r in discrete_quantile(df, ["g"], "v", "m").collect()}


def test_lower_median(spark):
    rows = [("a", v) for v in (10, 1, 3, 2)] + [("b", -4), ("b", None), (None, 7)]
    assert medians(spark, rows) == {"a": 2, "b": -4, None: 7}


@FEW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-5, 5)), min_size=1, max_size=80))
def test_median_is_the_row_at_half(spark, rows):
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert medians(spark, rows) == {g: sorted(v)[math.ceil(len(v) / 2) - 1] for g, v in groups.items()}


def test_other_quantile(spark):
    df = spark.createDataFrame([(v,) for v in range(1, 11)], "v int")
    assert discrete_quantile(df, [], "v", "q", 9, 10).first()["q"] == 9


def test_quantile_counts_before_the_window(spark):
    df = spark.createDataFrame([("a", 1)], "g string, v int")
    plan = plan_of(discrete_quantile(df, ["g"], "v", "m"))
    assert plan.index("Window") < plan.index("HashAggregate")  # the tree is printed from its top


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), max_size=50))
def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    once = any_per_key(df, ["k"])
    got = sorted(map(tuple, once.collect()))
    assert got == sorted({k: min(v for kk, v in rows if kk == k) for k, _ in rows}.items())
    assert sorted(map(tuple, any_per_key(once, ["k"]).collect())) == got


def test_top_one_is_limited_before_the_exchange(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    plan = plan_of(first_per_key(df, ["k"], [F.desc("v")]))
    assert plan.count("WindowGroupLimit") >= 2


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    assert {r["k"]: r["s"] for r in share_of_total(df, {"v": "s"}).collect()} == {"a": 0.25, "b": 0.75}
    zero = spark.createDataFrame([("a", 0)], "k string, v int")
    assert share_of_total(zero, {"v": "s"}).first()["s"] is None
