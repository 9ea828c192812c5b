import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwright.plans import reports as R
from cartwright.plans.analytics import analytics_orders, master_from_tables
from cartwright.sources.adapters import load_commerce
from support import rows

SCHEMA = ("order_id string, customer_id string, order_status string, "
          "order_purchase_timestamp timestamp_ntz, customer_state string, revenue decimal(28,2), "
          "delivery_days int, is_late boolean")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def ts(y, m, d):
    return dt.datetime(y, m, d, 12, 0)


def test_zero_total_revenue_gives_null_shares(spark):
    a = frame(spark, [("o1", "c1", "delivered", ts(2018, 1, 1), "SP", Decimal("0"), 3, False),
                      ("o2", "c2", "delivered", ts(2018, 1, 2), "RJ", Decimal("0"), 4, True)])
    st = R.state_performance_report(a).collect()
    assert all(r["revenue_share_percentage"] is None for r in st)
    run = R.running_revenue_report(a).collect()
    assert all(r["cumulative_revenue_percentage"] is None for r in run)


def test_ntile_with_ties_and_fewer_states_than_buckets(spark):
    a = frame(spark, [
        ("o1", "c1", "delivered", ts(2018, 1, 1), "SP", Decimal("10.00"), 1, False),
        ("o2", "c2", "delivered", ts(2018, 1, 1), "RJ", Decimal("10.00"), 1, False),
        ("o3", "c3", "delivered", ts(2018, 1, 1), "MG", Decimal("5.00"), None, False)])
    got = rows(R.state_performance_report(a), "customer_state", "revenue_rank", "revenue_quartile",
               "performance_tier", "avg_delivery_days")
    # ties share a dense rank; NTILE breaks the tie by state, 3 rows -> buckets 1,2,3
    assert got == [("MG", 2, 3, "Medium Performing", None),
                   ("RJ", 1, 1, "Top Performing", 1.0),
                   ("SP", 1, 2, "High Performing", 1.0)]


def test_monthly_lag_crosses_gaps_and_first_month_is_null(spark):
    a = frame(spark, [
        ("o1", "c1", "delivered", ts(2016, 10, 4), "SP", Decimal("100.00"), 1, False),
        ("o2", "c1", "delivered", ts(2016, 12, 4), "SP", Decimal("150.00"), 1, False),
        ("o3", "c1", "delivered", ts(2017, 1, 4), "SP", Decimal("0.00"), 1, False),
        ("o4", "c1", "delivered", ts(2017, 2, 4), "SP", Decimal("30.00"), 1, False)])
    got = R.monthly_revenue_report(a).collect()
    assert [r["month_name"] for r in got] == ["October", "December", "January", "February"]
    assert got[0]["previous_month_revenue"] is None and got[0]["growth_percentage"] is None
    assert got[1]["previous_month_revenue"] == 100.0 and got[1]["growth_percentage"] == 50.0
    assert got[3]["growth_percentage"] is None          # previous month revenue 0


def test_moving_average_counts_rows_not_days(spark):
    data = [(f"o{i}", "c", "delivered", ts(2018, 1, d), "SP", Decimal(v), 1, False)
            for i, (d, v) in enumerate([(1, "10"), (2, "20"), (10, "30")])]
    got = R.running_revenue_report(frame(spark, data)).collect()
    assert [r["seven_day_avg_revenue"] for r in got] == [10.0, 15.0, 20.0]
    assert got[-1]["cumulative_revenue_percentage"] == 100.0
    assert got[0]["seven_day_avg_revenue"] == got[0]["daily_revenue"]


def test_empty_input_gives_empty_reports(spark):
    a = frame(spark, [])
    for name, fn in R.REPORTS.items():
        assert fn(a).count() == 0, name


def test_delivery_report_counts(spark):
    a = frame(spark, [
        ("o1", "c1", "delivered", ts(2018, 1, 1), "SP", Decimal("1"), 10, True),
        ("o2", "c2", "delivered", ts(2018, 1, 1), "SP", Decimal("1"), 2, False),
        ("o3", "c3", "delivered", ts(2018, 1, 1), "SP", Decimal("1"), 3, False),
        ("o4", "c4", "canceled", ts(2018, 1, 1), "SP", Decimal("1"), None, False),
        ("o5", "c5", "delivered", ts(2018, 1, 1), None, Decimal("1"), 3, True)])
    r = R.delivery_analysis_report(a).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["delivered_orders"], r["late_orders"], r["on_time_orders"]) == (3, 1, 2)
    assert r["late_delivery_percentage"] == 33.33 and r["avg_delivery_days"] == 5.0


@pytest.fixture(scope="module")
def fixture_reports(spark, sf_small):
    a = analytics_orders(master_from_tables(load_commerce(spark, sf_small))).cache()
    out = {k: fn(a).collect() for k, fn in R.REPORTS.items()}
    out["_orders"] = a.count()
    out["_undelivered"] = a.where(F.col("delivery_days").isNull()).count()
    out["_zero_revenue"] = a.where(F.col("revenue") == 0).count()
    yield out
    a.unpersist()


def test_invariants_on_fixture(fixture_reports):
    r = fixture_reports
    n = r["_orders"]
    # I1: every report's order total equals the order count
    assert sum(x["total_orders"] for x in r["order_status"]) == n
    assert sum(x["total_orders"] for x in r["monthly_revenue"]) == n
    assert sum(x["total_orders"] for x in r["state_performance"]) == n
    assert sum(x["daily_orders"] for x in r["running_revenue"]) == n
    # I2: revenue totals agree across grains (exact cents)
    to_cents = lambda xs: round(sum(Decimal(str(x)) for x in xs) * 100)
    monthly = to_cents(x["monthly_revenue"] for x in r["monthly_revenue"])
    assert monthly == to_cents(x["total_revenue"] for x in r["state_performance"])
    assert monthly == to_cents(x["daily_revenue"] for x in r["running_revenue"])
    assert round(Decimal(str(r["running_revenue"][-1]["cumulative_revenue"])) * 100) == monthly
    # I3: delivered = orders - orders without a delivery date
    assert sum(x["delivered_orders"] for x in r["delivery_analysis"]) == n - r["_undelivered"]
    # I9: orders without a positive payment still count, with revenue 0
    assert r["_zero_revenue"] > 0
    # I4: late + on time = delivered
    assert all(x["late_orders"] + x["on_time_orders"] == x["delivered_orders"]
               for x in r["delivery_analysis"])
    # I5: last cumulative share is 100, first 7-row average is the first day's revenue
    assert r["running_revenue"][-1]["cumulative_revenue_percentage"] == 100.0
    assert r["running_revenue"][0]["seven_day_avg_revenue"] == r["running_revenue"][0]["daily_revenue"]
    # I6: NTILE bucket sizes differ by at most one, larger first
    sizes = [sum(1 for x in r["state_performance"] if x["revenue_quartile"] == q) for q in (1, 2, 3, 4)]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    # I8: first month has no previous month
    assert r["monthly_revenue"][0]["previous_month_revenue"] is None
    # I10: customers per state never exceed orders per state
    assert all(x["total_customers"] <= x["total_orders"] for x in r["state_performance"])
