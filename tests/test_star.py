import datetime as dt
from decimal import Decimal

import pytest

from conftest import plan_of
from feira import schemas
from feira.operators import quality, star


def when(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def inputs(spark):
    orders = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", when("2018-09-07 10:00:00"), when("2018-09-07 12:00:00"),
             when("2018-09-08 12:00:00"), when("2018-09-11 00:00:00"), when("2018-09-10 00:00:00")),
            ("o2", "c9", "created", when("2018-09-08 10:00:00"), None, None, None, when("2018-09-20 00:00:00")),
        ],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    )
    items = spark.createDataFrame(
        [
            ("o1", 1, "p1", "s1", 10.0, 1.5),
            ("o1", 2, "p1", "s1", 10.0, 1.5),
            ("o1", 3, "p9", "s1", 10.0, 1.5),
            ("o2", 1, "p2", "s1", 7.25, 0.0),
            ("o3", 1, "p2", "s1", 1.0, 0.0),
        ],
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
    )
    reviews = spark.createDataFrame(
        [
            ("r1", "o1", 1, when("2018-09-12 00:00:00")),
            ("r2", "o1", 5, when("2018-09-13 00:00:00")),
            ("r3", "o1", 2, None),
        ],
        "review_id string, order_id string, review_score int, review_answer_timestamp timestamp",
    )
    customers = spark.createDataFrame(
        [("c2", "u2", "02", "b", "SP"), ("c1", "u1", "01", "a", "RJ"), ("c1", "u1", "01", "a", "RJ")],
        schemas.RAW_SCHEMAS["customers"],
    )
    sellers = spark.createDataFrame([("s1", "01", "a", "RJ")], schemas.RAW_SCHEMAS["sellers"])
    products = spark.createDataFrame(
        [("p1", "moveis", 1.0, 2.0, 3.0), ("p2", "xyz", 1.0, 2.0, None)],
        "product_id string, product_category_name string, product_weight_g double, product_length_cm double, "
        "product_volume_cm3 double",
    )
    translation = spark.createDataFrame(
        [("moveis", "furniture"), ("moveis", "furnitures")], schemas.RAW_SCHEMAS["category_translation"]
    )
    dims = {
        "dim_customers": star.build_dim_customers(customers),
        "dim_sellers": star.build_dim_sellers(sellers),
        "dim_products": star.build_dim_products(products, translation),
        "dim_order_status": star.build_dim_order_status(orders),
        "dim_date": star.build_dim_date(orders),
    }
    return orders, items, reviews, dims


def build(inputs, **options):
    orders, items, reviews, dims = inputs
    names = ("dim_customers", "dim_products", "dim_sellers", "dim_order_status")
    return star.build_fct_order_items(items, orders, reviews, *[dims[n] for n in names], **options)


def test_dimensions(inputs):
    dims = inputs[3]
    assert [(r["customer_key"], r["customer_id"]) for r in dims["dim_customers"].orderBy("customer_key").collect()] == [
        (1, "c1"),
        (2, "c2"),
    ]
    assert {r["product_id"]: r["product_category_english"] for r in dims["dim_products"].collect()} == {
        "p1": "furniture",
        "p2": "xyz",
    }
    assert [r["status_name"] for r in dims["dim_order_status"].orderBy("status_key").collect()] == ["created", "delivered"]


def test_dates(inputs):
    dates = {r["date_key"]: r for r in inputs[3]["dim_date"].collect()}
    assert sorted(dates) == [20180907, 20180908, 20180910, 20180911, 20180920]
    holiday = dates[20180907]
    assert (holiday["day_of_week"], holiday["month_name"], holiday["quarter"], holiday["year"]) == (
        "Friday", "September", 3, 2018,
    )
    assert holiday["is_holiday_brazil"] and not dates[20180908]["is_holiday_brazil"]
    assert star.build_dim_date(inputs[0], calendar="contiguous").count() == 14


def test_fact_collapses_identical_units(inputs):
    rows = build(inputs).orderBy("order_item_key").collect()
    assert [(r["order_item_key"], r["order_id"], r["product_key"]) for r in rows] == [
        (1, "o1", None), (2, "o1", 1), (3, "o2", 2), (4, "o3", 2),
    ]
    first = rows[1]
    assert (first["customer_key"], first["seller_key"], first["review_score"]) == (1, 1, 5)
    assert (first["order_date_key"], first["estimated_delivery_date_key"], first["delivered_date_key"]) == (
        20180907, 20180910, 20180911,
    )
    assert first["processing_time_hours"] == Decimal("24.00") and first["shipping_time_days"] == 3
    assert rows[2]["customer_key"] is None and rows[2]["review_score"] == 3
    assert rows[2]["delivered_date_key"] is None and rows[2]["processing_time_hours"] is None
    assert rows[3]["status_key"] is None and rows[3]["order_date_key"] is None


def test_fact_with_every_unit(inputs):
    fact = build(inputs, collapse_identical=False)
    assert fact.count() == 5
    assert fact.schema.simpleString() == schemas.T.StructType.fromDDL(schemas.GOLD_SCHEMAS["fct_order_items"]).simpleString()
    assert "SinglePartition" not in plan_of(fact)


def test_unknown_product_fails_the_gate(inputs):
    results = quality.check_table(build(inputs), "gold", "fct_order_items", quality.GOLD_SUITE["fct_order_items"])
    failed = {r["constraint_name"] for r in results.collect() if r["constraint_status"] == "Failure"}
    assert failed == {"complete(customer_key)", "complete(product_key)"}


def test_foreign_keys(inputs, spark):
    dims = inputs[3]
    fact = build(inputs)
    clean = {r["foreign_key"]: r for r in quality.foreign_key_violations(fact, dims).collect()}
    assert len(clean) == 7 and not any(r["orphan_rows"] for r in clean.values())
    assert clean["customer_key"]["null_rows"] == 2 and clean["customer_key"]["checked_rows"] == 2
    broken = dict(dims, dim_sellers=dims["dim_sellers"].filter("false"))
    assert {
        r["foreign_key"]: r["orphan_rows"] for r in quality.foreign_key_violations(fact, broken).collect()
    }["seller_key"] == 4


def test_leads(inputs, spark):
    leads = spark.createDataFrame(
        [("l1", "s1", None, dt.date(2018, 1, 1), dt.date(2018, 1, 31)), ("l2", "s9", "social", None, None)],
        "lead_id string, seller_id string, channel string, first_contact_date date, won_date date",
    )
    rows = star.build_fct_marketing_leads(leads, inputs[3]["dim_sellers"]).orderBy("lead_key").collect()
    assert (rows[0]["seller_key"], rows[0]["channel"], rows[0]["sales_cycle_days"]) == (1, "unknown", 30)
    assert rows[1]["seller_key"] is None and rows[1]["won_date_key"] is None
