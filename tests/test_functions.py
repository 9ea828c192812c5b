import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions import (
    half_up_ratio, late_flag, month_name, normalize_boolean, safe_cast, safe_timestamp, tier_label,
)


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_half_up_ratio_exact_ties_and_signs(spark):
    data = [(1, 8), (5, 1000), (-5, 1000), (1, 3), (2, 3), (7, 0), (None, 4), (4, None), (1, -8)]
    got = one(spark, half_up_ratio("n", "d", 2), data, "n long, d long")
    # 0.125 -> 0.13, 0.005 -> 0.01 (HALF_UP), negatives round away from zero,
    # zero or NULL divisor -> NULL
    assert got == [0.13, 0.01, -0.01, 0.33, 0.67, None, None, None, -0.13]


def test_half_up_ratio_large_values(spark):
    data = [(10**20, 3)]
    got = one(spark, half_up_ratio(F.col("n").cast("decimal(38,0)"), "d", 2), data, "n string, d long")
    assert got == [3.3333333333333332e19]


def test_safe_cast_matches_try_cast_without_slow_path(spark):
    data = [("12",), (" 7 ",), ("x",), ("",), ("NaN",), ("1.5",), (None,)]
    ints = one(spark, safe_cast("s", "int", T.StringType()), data, "s string")
    assert ints == [12, 7, None, None, None, None, None]
    dbl = one(spark, safe_cast("s", "double", T.StringType()), data, "s string")
    assert dbl[0] == 12.0 and dbl[2] is None and dbl[5] == 1.5 and dbl[4] != dbl[4]
    bools = one(spark, safe_cast("s", "boolean", T.StringType()),
                [("T",), (" yes",), ("0",), ("maybe",), (None,)], "s string")
    assert bools == [True, True, False, None, None]


def test_normalize_boolean_text_rules(spark):
    data = [("TRUE",), (" yes ",), ("0",), ("n",), ("maybe",), (None,), ("F",), ("t",)]
    got = one(spark, normalize_boolean("s", T.StringType()), data, "s string")
    assert got == [True, True, False, False, None, None, False, True]
    # boolean input passes through untouched
    got = one(spark, normalize_boolean("b", T.BooleanType()), [(True,), (None,)], "b boolean")
    assert got == [True, None]
    # numbers: 2 is not a token but casts to true
    got = one(spark, normalize_boolean("i", T.IntegerType()), [(2,), (0,), (1,)], "i int")
    assert got == [True, False, True]


def test_safe_timestamp_bad_text_is_null(spark):
    data = [("2017-10-02 10:56:33",), ("not a date",), ("",), (None,)]
    got = one(spark, safe_timestamp("s", T.StringType()), data, "s string")
    assert got == [dt.datetime(2017, 10, 2, 10, 56, 33), None, None, None]


def test_late_flag_same_day_and_null(spark):
    est = dt.datetime(2018, 1, 10)
    data = [(dt.datetime(2018, 1, 10, 10, 0), est),   # later on the estimated day: late
            (dt.datetime(2018, 1, 10, 0, 0), est),    # exactly at midnight: on time
            (None, est)]                              # undelivered: not late
    got = one(spark, late_flag("d", "e"), data, "d timestamp_ntz, e timestamp_ntz")
    assert got == [True, False, False]


def test_month_name_and_tier(spark):
    got = one(spark, month_name("d"), [(dt.date(2017, 1, 5),), (dt.date(2017, 11, 1),)], "d date")
    assert got == ["January", "November"]
    got = one(spark, tier_label("q"), [(1,), (2,), (3,), (4,), (None,)], "q int")
    assert got == ["Top Performing", "High Performing", "Medium Performing", "Low Performing",
                   "Low Performing"]


def test_safe_timestamp_ignores_session_zone_in_dst_gap(spark):
    # 1996-10-06 00:00 does not exist in Sao Paulo local time (DST gap)
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = one(spark, safe_timestamp("s", T.StringType()), [("1996-10-06 00:00:00",)], "s string")
        names = one(spark, month_name("d"), [(dt.datetime(1996, 10, 6),)], "d timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got == [dt.datetime(1996, 10, 6, 0, 0)]
    assert names == ["October"]


def test_casts_strip_all_white_space(spark):
    data = [("\ttrue\n",), ("\x0b yes \x7f",), ("\u00a0true",)]
    assert one(spark, safe_cast("s", "boolean", T.StringType()), data, "s string") == [True, True, None]
    assert one(spark, F.col("s").try_cast("boolean"), data, "s string") == [True, True, None]
    assert one(spark, normalize_boolean("s", T.StringType()), [("\tN\n",)], "s string") == [False]


def test_fields_resolve_together(spark):
    import pytest

    from cartwright.functions import UnresolvedFields, resolve_fields

    names = ["ORDER_ID", "customer_id", "status", "order_date", "state", "revenue", "payment_value"]
    df = spark.createDataFrame([tuple("x" * len(names))], names)
    got = resolve_fields(df)
    assert got["order_id"] == "ORDER_ID" and got["revenue"] == "payment_value" and got["is_late"] is None
    with pytest.raises(UnresolvedFields) as e:
        resolve_fields(df.drop("state", "order_date"))
    assert "customer_state" in str(e.value) and "order_purchase_timestamp" in str(e.value)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(UnresolvedFields, match="order_id"):
            resolve_fields(df)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
