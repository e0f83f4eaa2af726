import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import plan_of
from feira.operators import quality
from feira.operators.quality import Complete, MaxLength, Satisfies, Unique

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
CHECKS = (Complete("k"), Unique("k"), Satisfies("v >= 0"), MaxLength("k", 1))


def results(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    return {r["constraint_name"]: r for r in quality.check_table(df, "raw", "t", CHECKS).collect()}


def test_statuses(spark):
    got = results(spark, [("a", 1), ("a", None), (None, -1), ("bb", 0)])
    assert {n: r["metric"] for n, r in got.items()} == {
        "complete(k)": 0.75,
        "unique(k)": 1 / 3,
        "satisfies(v >= 0)": 0.5,
        "max_length(k,1)": 0.75,
    }
    assert all(r["constraint_status"] == "Failure" and "0." in r["message"] for r in got.values())
    good = results(spark, [("a", 1), ("b", 0)])
    assert all(r["constraint_status"] == "Success" and r["message"] is None for r in good.values())


def test_table_without_rows_meets_nothing(spark):
    assert {r["constraint_status"] for r in results(spark, []).values()} == {"Failure"}


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "cc"])), st.one_of(st.none(), st.integers(-2, 2))), min_size=1, max_size=30))
def test_metrics_equal_counting(spark, rows):
    got = {n: r["metric"] for n, r in results(spark, rows).items()}
    keys = [k for k, _ in rows if k is not None]
    assert got["complete(k)"] == len(keys) / len(rows)
    assert got["unique(k)"] == (sum(keys.count(k) == 1 for k in keys) / len(keys) if keys else None)
    assert got["satisfies(v >= 0)"] == sum(v is not None and v >= 0 for _, v in rows) / len(rows)
    assert got["max_length(k,1)"] == sum(k is None or len(k) <= 1 for k, _ in rows) / len(rows)


def test_row_constraints_share_one_pass(spark):
    df = spark.range(10).selectExpr("cast(id as string) k", "cast(id as int) v")
    plan = plan_of(quality.check_table(df, "raw", "t", (CHECKS[0], CHECKS[2], CHECKS[3])))
    assert plan.count("Range (") == 2  # once in the tree, once in the details


def test_missing_table_is_visible(spark):
    suite = {"t": (Complete("k"),), "gone": (Complete("k"),)}
    df = spark.createDataFrame([("a",)], "k string")
    found = quality.check_layer(spark, "raw", suite, lambda name: df if name == "t" else None)
    assert {r["table_name"]: r["constraint_status"] for r in found.collect()} == {"t": "Success", "gone": "Skipped"}
    with pytest.raises(quality.DataQualityError, match="gone"):
        quality.gate(found)
    assert len(quality.gate(found, strict=False)) == 2


def test_gate_reports_every_failure(spark):
    df = spark.createDataFrame([(None, -1)], "k string, v int")
    found = quality.check_table(df, "raw", "t", CHECKS)
    assert quality.failed_count(found).first()[0] == 3
    with pytest.raises(quality.DataQualityError, match="3 constraint"):
        quality.gate(found)
