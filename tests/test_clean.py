import datetime as dt

from pyspark.sql import types as T

from cartwright.operators.clean import (
    clean_column_names, clean_orders, dedup_by_key, fill_nulls, positive_payments,
)
from support import rows

ORDER_SCHEMA = ("order_id string, customer_id string, order_status string, "
                "order_purchase_timestamp string, order_approved_at string, "
                "order_delivered_carrier_date string, order_delivered_customer_date string, "
                "order_estimated_delivery_date string")


def test_dedup_is_deterministic_and_prefers_non_null(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), ("a", 2, "y"), ("b", None, "z"), ("b", None, None)],
        "k string, v int, w string")
    got = rows(dedup_by_key(df, ["k"]))
    assert got == [("a", 2, "y"), ("b", None, "z")]
    got = rows(dedup_by_key(df, ["k"], prefer=["w"]))
    assert got == [("a", 2, "y"), ("b", None, "z")]
    # repeated runs (and repartitioned input) pick the same survivor
    again = rows(dedup_by_key(df.repartition(3), ["k"]))
    assert again == got


def test_clean_orders_types_derives_and_dedups(spark):
    data = [
        ("o1", "c1", "delivered", "2017-10-15 23:50:00", "2017-10-16 10:00:00", None,
         "2017-10-18 00:10:00", "2017-10-18 00:00:00"),
        ("o1", "c1", "delivered", "2017-10-15 23:50:00", "garbage", None,
         "2017-10-18 00:10:00", "2017-10-18 00:00:00"),
        ("o2", "c2", "shipped", "bad timestamp", None, None, None, "2017-11-01 00:00:00"),
        (None, "c3", "created", "2017-10-02 10:00:00", None, None, None, None),
    ]
    out = clean_orders(spark.createDataFrame(data, ORDER_SCHEMA))
    by_id = {r["order_id"]: r for r in out.collect()}
    assert set(by_id) == {"o1", "o2", None}
    o1 = by_id["o1"]
    assert o1["purchase_day_of_week"] == 1          # 2017-10-15 is a Sunday
    assert o1["delivery_days"] == 3                 # calendar days, time ignored
    assert o1["is_late"] is True                    # 00:10 after a midnight estimate
    assert o1["order_approved_at"] == dt.datetime(2017, 10, 16, 10, 0)  # greatest survivor
    o2 = by_id["o2"]
    assert o2["order_purchase_timestamp"] is None and o2["purchase_year"] is None
    assert o2["is_late"] is False                   # undelivered counts as not late
    assert dict(out.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"


def test_fill_nulls_and_positive_payments(spark):
    p = spark.createDataFrame([("p1", None, None, 3)], "product_id string, product_category_name string, "
                              "product_weight_g int, product_photos_qty int")
    assert rows(fill_nulls(p)) == [("p1", "unknown", 0, 3)]
    pay = spark.createDataFrame([(1, 10.0), (2, 0.0), (3, -1.0), (4, None)], "order_id int, payment_value double")
    assert rows(positive_payments(pay), "order_id") == [(1,)]


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2)], T.StructType([
        T.StructField(" Order ID ", T.IntegerType()), T.StructField("Customer-State(raw)", T.IntegerType())]))
    assert clean_column_names(df).columns == ["order_id", "customer_state_raw"]


def test_clean_column_names_keeps_names_apart(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], ["A b", "a-b", "a_b_2", " a  b ", "!!"])
    got = clean_column_names(df).columns
    assert got == ["a_b", "a_b_3", "a_b_2", "a_b_4", "col"] and len(set(got)) == 5
