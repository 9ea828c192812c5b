from decimal import Decimal

from pyspark.sql import functions as F

from cartwright.operators.aggregate import aggregate_payments
from cartwright.operators.clean import dedup_by_key
from cartwright.plans.insights import review_score_distribution
from support import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_dedup_is_combined_before_the_shuffle(spark):
    # one key holds a third of all rows
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 7 % 1000).alias("v"))
    out = dedup_by_key(df, ["k"])
    got = {r["k"]: r["v"] for r in out.collect()}
    assert len(got) == n - n // 3 + 1
    assert got[-1] == max(i * 7 % 1000 for i in range(0, n, 3))
    plan = _plan(out)
    # partial aggregate below the exchange = map-side combine of the hot key
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")


def test_hot_order_payments(spark):
    data = [(1, i, "card" if i % 2 else "boleto", Decimal("1.00")) for i in range(1, 2001)] + \
           [(2, 1, "card", Decimal("5.00"))]
    pay = spark.createDataFrame(
        data, "order_id long, payment_sequential int, payment_type string, payment_value decimal(18,2)")
    got = {r["order_id"]: r for r in aggregate_payments(pay).collect()}
    assert got[1]["total_payment"] == Decimal("2000.00") and got[1]["payment_count"] == 2000
    assert got[1]["payment_types"] == ["boleto", "card"]
    assert "partial_collect_set" in _plan(aggregate_payments(pay))


def test_review_score_distribution(spark):
    reviews = spark.createDataFrame(
        [("r1", 5, "great"), ("r2", 5, None), ("r3", 1, "bad"), ("r4", None, None)],
        "review_id string, review_score int, review_comment_message string")
    got = rows(review_score_distribution(reviews))
    assert got == [(1, 1, 1, 33.33), (5, 2, 1, 66.67)]
