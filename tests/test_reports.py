import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_of
from feira.functions.geo import haversine_km
from feira.operators import churn, logistics, reviews, sales, scd
from feira.schemas import GOLD_SCHEMAS, conform
from feira.sources import readers


def star_row(order, customer, product, seller, day, price, freight=1.0, score=3, delivered=None, estimated=20180110, status=1, hours=None, days=None):
    return (None, order, customer, product, seller, day, estimated, delivered, status, price, freight, score, hours, days)


@pytest.fixture(scope="module")
def fact(spark):
    rows = [
        star_row("o1", 1, 1, 1, 20180101, 10.0, 2.0, 1, delivered=20180112, hours=5.0, days=3),
        star_row("o1", 1, 2, 1, 20180101, 30.0, 2.0, 1, delivered=20180112, hours=7.0, days=5),
        star_row("o2", 2, 1, 2, 20180301, 60.0, 3.0, 5, delivered=20180109, hours=1.0, days=1),
        star_row("o3", 1, None, 2, 20180302, 0.0, 0.0, 3, status=2),
    ]
    schema = GOLD_SCHEMAS["fct_order_items"].replace("decimal(10,2)", "double")
    return spark.createDataFrame(rows, schema).selectExpr(
        "* except (item_price, freight_value)", "cast(item_price as decimal(10,2)) item_price", "cast(freight_value as decimal(10,2)) freight_value"
    )


@pytest.fixture(scope="module")
def dims(spark):
    return {
        "products": spark.createDataFrame([(1, "toys"), (2, "books")], "product_key bigint, product_category_english string"),
        "customers": spark.createDataFrame(
            [(1, "c1", "u1", "00001", "a", "SP"), (2, "c2", "u2", "00002", "b", "RJ")], GOLD_SCHEMAS["dim_customers"]
        ),
        "sellers": spark.createDataFrame([(1, "s1", "00001", "a", "SP"), (2, "s2", "00002", "b", "RJ")], GOLD_SCHEMAS["dim_sellers"]),
        "status": spark.createDataFrame([(1, "delivered"), (2, "created")], GOLD_SCHEMAS["dim_order_status"]),
        "geo": spark.createDataFrame(
            [(1, -23.0, -46.0), (1, -25.0, -46.0), (2, -22.9, -43.2)],
            "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double",
        ),
    }


def keyed(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


def test_category_reports(fact, dims):
    funnel = keyed(sales.category_funnel(fact, dims["products"]), "product_category_english")
    assert funnel["toys"]["orders"] == 2 and funnel["toys"]["revenue_share"] == 0.7
    assert funnel[None]["orders"] == 1
    ranks = keyed(sales.category_rank(fact, dims["products"]), "month", "product_category_english")
    assert ranks[(201801, "books")]["revenue_rank"] == 1 and ranks[(201801, "toys")]["revenue_rank"] == 2


def test_order_value(fact, dims):
    row = sales.average_order_value(fact, dims["status"]).first()
    assert (row["items"], row["orders"], row["value_per_order"]) == (3, 2, 50.0)
    assert row["value_per_item_row"] == 100 / 3


def test_trend_uses_the_calendar_month_before(fact):
    trend = keyed(sales.monthly_trend(fact), "month")
    assert trend[201803]["previous_revenue"] is None and trend[201803]["revenue_ytd"] == 100
    undated = fact.withColumn("order_date_key", F.lit(None).cast("int"))
    whole = keyed(sales.monthly_trend(fact.unionByName(undated)), "month")
    assert whole.pop(None)["revenue"] == sum(r["revenue"] for r in trend.values()) and whole == trend


def test_payment_mix(spark):
    payments = spark.createDataFrame(
        [("boleto", 1, 10.0), ("card", 3, 20.0), ("card", 5, 10.0)],
        "payment_type string, payment_installments int, payment_value double",
    )
    mix = keyed(sales.payment_mix(payments), "payment_type")
    assert mix["card"]["value_share"] == 0.75 and mix["card"]["avg_installments"] == 4.0
    assert mix["boleto"]["payment_share"] == 1 / 3


def test_places(fact, dims):
    share = keyed(sales.state_share(fact, dims["customers"]), "customer_state")
    assert share["SP"]["customers"] == 1 and share["SP"]["revenue_share"] == 0.4
    totals = keyed(sales.place_subtotals(fact, dims["customers"]), "level", "customer_state")
    assert totals[(3, None)]["items"] == 4 and totals[(1, "SP")]["items"] == 3
    cells = keyed(logistics.geo_grid(fact, dims["customers"], dims["geo"]), "cell_lat")
    assert cells[-24.0]["items"] == 3 and cells[-22.9]["customers"] == 1
    lanes = keyed(logistics.lane_distance(fact, dims["sellers"], dims["customers"], dims["geo"]), "seller_zip", "customer_zip")
    assert lanes[(1, 1)]["distance_km"] == 0.0 and lanes[(2, 1)]["items"] == 1


def test_great_circle(spark):
    from pyspark.sql import functions as F

    km = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))).first()[0]
    assert km == pytest.approx(10007.5, abs=0.1)


def test_delivery_reports(fact, dims):
    rate = keyed(logistics.on_time_rate(fact), "order_year")[2018]
    assert (rate["delivered_items"], rate["late_items"]) == (3, 2) and rate["on_time_rate"] == 1 / 3
    processing = keyed(logistics.seller_processing(fact, dims["sellers"]), "seller_id")
    assert (processing["s1"]["avg_hours"], processing["s1"]["median_hours"]) == (6.0, 5.0)
    lanes = keyed(logistics.lane_shipping(fact, dims["sellers"], dims["customers"]), "seller_state", "customer_state")
    assert lanes[("SP", "SP")]["avg_shipping_days"] == 4.0 and lanes[("RJ", "SP")]["avg_shipping_days"] is None


def test_review_reports(fact, spark):
    scores = keyed(reviews.score_distribution(fact), "review_score")
    assert scores[1]["share"] == 0.5
    delays = keyed(reviews.score_vs_delay(fact), "review_score")
    assert delays[1]["avg_delay_days"] == 2.0 and delays[5]["late_share"] == 0.0 and 3 not in delays
    assert reviews.score_delay_correlation(fact).first()["correlation"] == pytest.approx(-1.0)
    comments = spark.createDataFrame(
        [(1, "nunca chegou nunca"), (5, "nunca mais"), (2, ""), (1, None)], "review_score int, review_comment_cleaned string"
    )
    assert keyed(reviews.negative_words(comments), "word").keys() == {"nunca", "chegou"}
    found = keyed(reviews.keyword_mentions(comments, ["nunca chegou", "atraso"]), "review_score", "phrase")
    assert found[(1, "nunca chegou")]["mentions"] == 1 and found[(1, "atraso")]["mentions"] == 0


def test_buyers_and_label(spark):
    day = dt.datetime.fromisoformat
    orders = spark.createDataFrame(
        [("c1", day("2018-01-01")), ("c2", day("2018-02-01")), ("c3", day("2018-03-01")), ("c1", day("2018-07-01")),
         ("c4", day("2018-08-01"))],
        "customer_id string, order_purchase_timestamp timestamp",
    )
    customers = spark.createDataFrame(
        [("c1", "u1"), ("c2", "u2"), ("c3", "u2"), ("c4", "u4")], "customer_id string, customer_unique_id string"
    )
    once = sales.one_time_buyers(orders, customers).first()
    assert (once["buyers"], once["one_time_buyers"]) == (3, 1)
    label = keyed(churn.churn_label(orders, customers, "2018-06-01", 60), "customer_unique_id")
    assert {k: r["churned"] for k, r in label.items()} == {"u1": 0, "u2": 1}


def test_customer_features(fact, dims, spark):
    payments = spark.createDataFrame([("o1", 3), ("o1", 8), ("o3", 1)], "order_id string, payment_installments int")
    profile = keyed(churn.rfm(fact, dims["customers"], "2018-03-12"), "customer_unique_id")
    assert (profile["u1"]["recency_days"], profile["u1"]["frequency"], profile["u1"]["monetary"]) == (10, 2, 40.0)
    pain = keyed(churn.friction(fact, dims["customers"]), "customer_unique_id")
    assert pain["u1"]["delivery_delay_days"] == 2.0 and pain["u1"]["freight_ratio"] == 0.1
    felt = keyed(churn.experience(fact, payments, dims["customers"]), "customer_unique_id")
    assert felt["u1"]["avg_review_score"] == 5 / 3 and felt["u1"]["max_installments"] == 8
    assert felt["u2"]["max_installments"] is None


def test_models_find_a_planted_signal(spark):
    rows = [(f"u{i}", int(i % 4 > 0), 300 if i % 4 else 5 + i % 7, 1 + i % 3, float(i % 13), float(i % 5), 0.1, 3.0, i % 4 + 1) for i in range(240)]
    table = spark.createDataFrame(
        rows,
        "customer_unique_id string, churned int, recency_days int, frequency int, monetary double, "
        "delivery_delay_days double, freight_ratio double, avg_review_score double, max_installments int",
    )
    logistic = churn.train_logistic(table, reg_params=(0.01,), elastic_net_params=(0.0,))
    assert len(logistic.features) == 4 and "recency_days" in logistic.features and logistic.pr_auc > 0.9
    boosted = churn.train_boosted(table, rounds=3, depth=2)
    assert boosted.pr_auc > 0.9
    for model in (logistic, boosted):
        flagged = {r[0] for r in churn.alerts(churn.score(table, model)).collect()}
        assert flagged == {r[0] for r in rows if r[1] == 1}


def test_history_of_a_dimension(spark):
    at = dt.datetime.fromisoformat
    start = spark.createDataFrame([("a", "x"), ("b", "x"), ("d", None)], "k string, city string")
    history = scd.start_history(start, "k", ["city"], "2018-01-01")
    updates = spark.createDataFrame(
        [
            ("a", "x", at("2018-02-01")),
            ("a", "y", at("2018-03-01")),
            ("a", "x", at("2018-04-01")),
            ("c", "new", at("2018-02-01")),
            ("d", None, at("2018-02-01")),
        ],
        "k string, city string, at timestamp",
    )

    def versions(df):
        return sorted(
            [(r["k"], r["city"], r["valid_from"].month, r["valid_to"] and r["valid_to"].month, r["is_current"]) for r in df.collect()],
            key=str,
        )

    merged = scd.scd2_merge(history, updates, "k", ["city"], "at")
    expected = [
        ("a", "x", 1, 3, False), ("a", "x", 4, None, True), ("a", "y", 3, 4, False),
        ("b", "x", 1, None, True), ("c", "new", 2, None, True), ("d", None, 1, None, True),
    ]
    assert versions(merged) == sorted(expected, key=str)
    late = spark.createDataFrame(
        [("a", "w", at("2018-02-15")), ("a", "q", at("2018-03-01")), ("a", "v", at("2018-02-15"))],
        "k string, city string, at timestamp",
    )
    found = versions(scd.scd2_merge(merged, late, "k", ["city"], "at"))
    assert [f for f in found if f[0] == "a"] == sorted(
        [("a", "x", 1, 2, False), ("a", "w", 2, 3, False), ("a", "q", 3, 4, False), ("a", "x", 4, None, True)], key=str
    )
    later = spark.createDataFrame([("b", "z", at("2018-05-01"))], "k string, city string, at timestamp")
    again = versions(scd.scd2_merge(merged, later, "k", ["city"], "at"))
    assert ("b", "x", 1, 5, False) in again and ("b", "z", 5, None, True) in again and len(again) == 7


def test_versions_of_a_key_never_overlap(spark):
    """Random batches with late updates: versions are gapless, and what the last batch said holds at its time.

    (A repeat of the known state leaves no trace, so a later update that comes before it can hide it.)
    """
    rng = random.Random(5)
    at = dt.datetime(2018, 1, 1)
    start = spark.createDataFrame([(k, "s") for k in "abc"], "k string, city string")
    history = scd.start_history(start, "k", ["city"], "2018-01-01")
    updates = {(rng.choice("abcd"), at + dt.timedelta(days=rng.randint(1, 40))): rng.choice("xyz") for _ in range(40)}
    rows = [(k, city, when) for (k, when), city in updates.items()]
    rng.shuffle(rows)
    schema = "k string, city string, at timestamp"
    merged = history
    for begin in (0, 14, 28):
        merged = scd.scd2_merge(merged, spark.createDataFrame(rows[begin : begin + 14], schema), "k", ["city"], "at")
    by_key = {}
    for r in merged.collect():
        by_key.setdefault(r["k"], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r["valid_from"])
        for a, b in zip(versions, versions[1:]):
            assert a["valid_to"] == b["valid_from"] and a["city"] != b["city"] and not a["is_current"]
        assert versions[-1]["valid_to"] is None and versions[-1]["is_current"]
        for r in rows[28:]:
            if r[0] == versions[0]["k"]:
                valid = [v["city"] for v in versions if v["valid_from"] <= r[2] and (v["valid_to"] is None or r[2] < v["valid_to"])]
                assert valid == [r[1]]


def test_values_that_do_not_fit_stop_the_build(spark):
    row = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in T.StructType.fromDDL(GOLD_SCHEMAS["fct_order_items"]).names])
    priced = row.withColumn("item_price", F.lit(150_000_000.0))
    with pytest.raises(Exception, match="fct_order_items.item_price"):
        conform(priced, "fct_order_items").collect()
    assert conform(row, "fct_order_items").count() == 1
    paid = spark.createDataFrame([("card", 1, 1e20)], "payment_type string, payment_installments int, payment_value double")
    with pytest.raises(Exception, match="payment_value"):
        sales.payment_mix(paid).collect()


def test_unknown_parties_stay_in_the_reports(fact, dims, spark):
    one = dims["customers"].filter("customer_key = 1"), dims["sellers"].filter("seller_key = 1")
    geo = dims["geo"].filter("geolocation_zip_code_prefix = 9")
    everything = fact.count()
    for df in (
        logistics.geo_grid(fact, one[0], dims["geo"]),
        logistics.geo_grid(fact, dims["customers"], geo),
        logistics.geo_grid(fact, one[1], dims["geo"], party="seller"),
        logistics.lane_distance(fact, one[1], one[0], dims["geo"]),
        logistics.state_lane_distance(fact, one[1], one[0], dims["geo"]),
    ):
        assert df.agg(F.sum("items")).first()[0] == everything
    timed = fact.filter("processing_time_hours is not null")
    nobody = timed.withColumn("seller_key", F.lit(None).cast("bigint"))
    found = logistics.seller_processing(timed.unionByName(nobody), dims["sellers"])
    assert found.agg(F.sum("items")).first()[0] == 2 * timed.count()


def test_noise_is_reported_as_no_model(spark):
    rng = random.Random(3)
    rows = [(f"u{i}", rng.randint(0, 1), 5, 1, 2.0, 0.0, 0.1, 3.0, 1) for i in range(300)]
    schema = (
        "customer_unique_id string, churned int, recency_days int, frequency int, monetary double, "
        "delivery_delay_days double, freight_ratio double, avg_review_score double, max_installments int"
    )
    assert churn.train_logistic(spark.createDataFrame(rows, schema)).degenerate


def test_ranges_reach_the_scan(spark, tmp_path, fact):
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    leads = spark.createDataFrame([], GOLD_SCHEMAS["fct_marketing_leads"])
    sellers = spark.createDataFrame([], GOLD_SCHEMAS["dim_sellers"])
    quarter = plan_of(sales.channel_sellers(stored, leads.union(leads), sellers, 2018, 1))
    reviews_ = spark.createDataFrame([], "order_id string, review_id string, review_score int, review_answer_timestamp timestamp")
    past = plan_of(churn.before_cutoff(stored, reviews_, "2018-03-01"))
    assert "LessThan(order_date_key,20180301)" in past
    assert "GreaterThanOrEqual(order_date_key,20180101)" in quarter or "LocalTableScan" in quarter
    orders = spark.createDataFrame([("o", dt.datetime(2018, 1, 1))], "order_id string, t timestamp")
    orders.write.parquet(str(tmp_path / "orders"))
    ranged = plan_of(readers.in_range(spark.read.parquet(str(tmp_path / "orders")), "t", "2018-01-01", "2018-02-01"))
    assert "GreaterThanOrEqual(t," in ranged and "LessThanOrEqual(t," in ranged
