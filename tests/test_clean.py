import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feira import schemas
from feira.functions.casts import iso_timestamp, to_double, to_int, to_timestamp
from feira.functions.dates import date_key, date_of_key, hours_between, is_fixed_holiday, whole_days_between
from feira.functions.text import PORTUGUESE_STOPWORDS, clean_text, mentions
from feira.operators.clean import (
    clean_reviews,
    clean_table,
    impute_delivery,
    merge_batch_and_stream,
    parse_logistics,
    parse_payload,
)


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(column).first()[0]


@pytest.mark.parametrize("text, expected", [("5", 5), ("5.0", 5), ("oops", None), ("", None), (None, None), ("99999999999", None)])
def test_int_forms(spark, text, expected):
    assert one(spark, to_int(F.lit(text).cast("string"))) == expected


def test_malformed_values_become_null(spark):
    assert one(spark, to_double(F.lit("oops"))) is None
    assert one(spark, to_timestamp(F.lit("oops"))) is None
    assert one(spark, to_timestamp(F.lit("2018-01-02 10:11:12"))) == dt.datetime(2018, 1, 2, 10, 11, 12)


@pytest.mark.parametrize(
    "text",
    ["2018-1-02 10:11:12", "2018-01-02", "2018-01-02T10:11:12", "2018-01-02 10:11:12 ", " 2018-01-02 10:11:12",
     "2018-13-02 10:11:12", "2018-01-02 24:00:00", "2018-01-02 10:11:12Z", "12018-1-02 10:11:12", "2018-02-30 00:00:00"],
)
def test_timestamp_format_is_exact(spark, text):
    assert one(spark, to_timestamp(F.lit(text))) is None
    assert one(spark, F.try_to_timestamp(F.lit(text), F.lit("yyyy-MM-dd HH:mm:ss"))) is None


def test_other_timestamp_format(spark):
    assert one(spark, to_timestamp(F.lit("02/01/2018"), "dd/MM/yyyy")) == dt.datetime(2018, 1, 2)


def test_iso_timestamp_with_zone_letter(spark):
    shown = F.date_format(iso_timestamp(F.lit("2018-01-02T10:11:12Z")), "yyyy-MM-dd HH:mm:ss")
    assert one(spark, shown) == "2018-01-02 10:11:12"


def test_dates(spark):
    day = F.lit("2018-09-07").cast("date")
    assert one(spark, date_key(day)) == 20180907
    assert one(spark, date_of_key(F.lit(20180907))) == dt.date(2018, 9, 7)
    assert one(spark, is_fixed_holiday(day)) is True
    assert one(spark, is_fixed_holiday(F.lit("2018-09-08").cast("date"))) is False
    start = F.lit("2018-01-01 00:00:00").cast("timestamp")
    for end, days in (("2018-01-03 12:00:00", 3), ("2017-12-29 12:00:00", -3), ("2018-01-02 11:59:59", 1)):
        assert one(spark, whole_days_between(start, F.lit(end).cast("timestamp"))) == days
    assert one(spark, hours_between(start, F.lit("2018-01-01 00:07:30").cast("timestamp"))) == 0.13


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None),
        ("  ", None),
        ("de a o", ""),
        ("!!! 123", ""),
        ("<b>Não</b> BOM,mas é", "bommas é"),
        ("irmã", "irmã"),
        ("Produto  CHEGOU\n\tantes", "produto chegou antes"),
        ("bom, produto 10!", "bom produto"),
        ("era <br/> uma vez", "vez"),
    ],
)
def test_clean_text(spark, text, expected):
    assert one(spark, clean_text(F.lit(text).cast("string"))) == expected


def test_clean_text_is_idempotent_and_takes_other_words(spark):
    once = clean_text(F.lit("Muito <i>bom</i>, não atrasou 2 dias!"))
    assert one(spark, clean_text(once)) == one(spark, once)
    assert one(spark, clean_text(F.lit("irmã a irm"), stopwords=["a", "irm"])) == "irmã"
    assert one(spark, clean_text(F.lit("de bom"), stopwords=[])) == "de bom"
    assert len(PORTUGUESE_STOPWORDS) == len(set(PORTUGUESE_STOPWORDS)) == 202


def test_mentions_whole_words(spark):
    assert one(spark, mentions(F.lit("nunca chegou aqui"), "nunca chegou")) is True
    assert one(spark, mentions(F.lit("atrasos"), "atraso")) is False


def test_products(spark):
    raw = spark.createDataFrame(
        [("p1", None, "1", "1", "1", "100", "2", "3", "4"), ("p2", "x", "1", "1", "1", "bad", "2", "3", None)],
        schemas.RAW_SCHEMAS["products"],
    ).withColumn(schemas.INGESTED_AT, F.current_timestamp())
    rows = {r["product_id"]: r for r in clean_table(raw, "products").collect()}
    assert rows["p1"]["product_category_name"] == "unknown" and rows["p1"]["product_volume_cm3"] == 24.0
    assert rows["p2"]["product_weight_g"] is None and rows["p2"]["product_volume_cm3"] is None
    assert schemas.INGESTED_AT not in clean_table(raw, "products").columns


def test_missing_cast_columns_are_ignored_and_zip_stays_text(spark):
    few = spark.createDataFrame([("o1", "5.0")], "order_id string, order_item_id string")
    assert clean_table(few, "order_items").first().asDict() == {"order_id": "o1", "order_item_id": 5}
    customers = spark.createDataFrame([("c", "u", "01151", "sp", "SP")], schemas.RAW_SCHEMAS["customers"])
    assert clean_table(customers, "customers").first()["customer_zip_code_prefix"] == "01151"


def test_reviews_default_score(spark):
    raw = spark.createDataFrame(
        [("r1", "o1", None, None, "BOM", "2018-01-01 00:00:00", None), ("r2", "o1", "5.0", None, None, "bad", None)],
        schemas.RAW_SCHEMAS["order_reviews"],
    )
    rows = {r["review_id"]: r for r in clean_reviews(raw).collect()}
    assert rows["r1"]["review_score"] == 3 and rows["r1"]["review_comment_cleaned"] == "bom"
    assert rows["r2"]["review_score"] == 5 and rows["r2"]["review_comment_cleaned"] is None


PAYLOAD = schemas.RAW_SCHEMAS["orders"]


def archive(spark, messages):
    rows = [("k", value, schemas.ORDERS_TOPIC, 0, offset, None, None) for offset, value in messages]
    return spark.createDataFrame(rows, schemas.ARCHIVE_SCHEMA)


def order(order_id, status, **more):
    return {**dict.fromkeys(PAYLOAD.names), "order_id": order_id, "order_status": status, **more}


def test_payload_parsing(spark):
    rows = parse_payload(
        archive(spark, [(1, "{bad"), (2, json.dumps({**order("o1", "x"), "extra": 1})), (3, None)]), PAYLOAD
    ).orderBy("kafka_offset").collect()
    assert [r["order_id"] for r in rows] == [None, "o1", None]


def test_merge_newest_message_wins(spark):
    batch = spark.createDataFrame([order("o1", "created"), order("o2", "created")], PAYLOAD)
    stream = archive(
        spark,
        [
            (5, json.dumps(order("o1", "delivered"))),
            (3, json.dumps(order("o1", "shipped"))),
            (4, json.dumps(order("o3", "shipped"))),
            (4, json.dumps(order("o3", "shipped"))),
        ],
    )
    merged = merge_batch_and_stream(batch, stream, PAYLOAD, "order_id")
    assert {r["order_id"]: r["order_status"] for r in merged.collect()} == {
        "o1": "delivered",
        "o2": "created",
        "o3": "shipped",
    }
    assert merged.count() == 3
    alone = merge_batch_and_stream(batch.union(batch), None, PAYLOAD, "order_id")
    assert alone.count() == 2 and alone.columns == batch.columns


def test_logistics_latest_message(spark):
    def message(day):
        return json.dumps(
            {
                "order_id": "o1",
                "customer_id": "c1",
                "delivered_carrier_date": None,
                "delivered_customer_date": f"2018-01-0{day} 00:00:00",
                "estimated_delivery_date": "oops",
            }
        )

    row = parse_logistics(archive(spark, [(1, message(1)), (2, message(2))])).collect()
    assert len(row) == 1 and row[0]["delivered_customer_date"] == dt.datetime(2018, 1, 2)
    assert row[0]["estimated_delivery_date"] is None


ORDERS = "order_id string, customer_id string, order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp"


def moment(text):
    return dt.datetime.fromisoformat(text) if text else None


def test_imputation(spark):
    carrier = moment("2018-01-02 10:11:12")
    rows = [(f"o{i}", "c1", moment("2018-01-01"), moment("2018-01-01") + dt.timedelta(days=d)) for i, d in enumerate((1, 2, 3, 10))]
    rows += [
        ("missing", "c1", carrier, None),
        ("no carrier", "c1", None, None),
        ("no median", "c2", carrier, None),
        ("null zip", "c3", carrier, None),
        ("unknown customer", "c9", carrier, None),
        ("null zip with duration", "c3", carrier, carrier),
        ("before carrier", "c4", carrier, moment("2018-01-01")),
        ("negative", "c4", carrier, None),
    ]
    customers = spark.createDataFrame(
        [("c1", "01"), ("c1", "01"), ("c2", "02"), ("c3", None), ("c4", "04")],
        "customer_id string, customer_zip_code_prefix string",
    )
    orders = spark.createDataFrame(rows, ORDERS)
    result = impute_delivery(orders, customers, flag_col="is_imputed")
    got = {r["order_id"]: r for r in result.collect()}
    assert len(got) == len(rows) == result.count()
    assert got["missing"]["order_delivered_customer_date"] == moment("2018-01-04")
    assert got["missing"]["is_imputed"] and not got["o1"]["is_imputed"]
    assert got["negative"]["order_delivered_customer_date"] == moment("2018-01-01")
    for name in ("no carrier", "no median", "null zip", "unknown customer"):
        assert got[name]["order_delivered_customer_date"] is None and not got[name]["is_imputed"]
    filled = {r["order_id"]: r for r in impute_delivery(orders, customers, fallback="global").collect()}
    assert filled["no median"]["order_delivered_customer_date"] == moment("2018-01-03")
    assert filled["no carrier"]["order_delivered_customer_date"] is None
    with pytest.raises(ValueError):
        impute_delivery(orders, customers, fallback="other")
