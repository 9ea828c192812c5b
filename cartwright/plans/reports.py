"""The five analytics reports plus the report registry.

Each report aggregates ``analytics_orders`` to a report grain (status,
month, state, day) with partial+final hash aggregation, then applies its
windows to those few rows.  Money is summed as exact decimals and turned
into double only in the final projection; every rounded ratio is HALF_UP
on the exact quotient.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.scalars import cents, half_up_ratio, month_name
from cartwright.operators.windows import (
    dense_rank_desc,
    growth_percentage,
    lag_previous,
    moving_average_rows,
    ntile_desc,
    performance_tier,
    running_sum,
    share_of_total_window,
)
from cartwright.plans.analytics import delivery_view

DOUBLE = "double"


def _avg_money(revenue: str = "revenue"):
    """ROUND(AVG(revenue), 2) from exact cents; NULLs ignored."""
    return half_up_ratio(F.sum(cents(revenue)), F.count(revenue) * 100, 2)


def _avg_days(days: str = "delivery_days"):
    return half_up_ratio(F.sum(days), F.count(days), 2)


def order_status_report(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("total_orders"))
        .transform(share_of_total_window, F.col("total_orders"), "order_percentage")
        .orderBy(F.col("total_orders").desc(), F.col("order_status"))
    )


def monthly_orders(analytics: DataFrame) -> DataFrame:
    """Orders and exact revenue per calendar month of purchase."""
    return (
        analytics.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(F.date_trunc("month", "order_purchase_timestamp").alias("order_month"))
        .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("revenue").alias("monthly_revenue"))
    )


def monthly_revenue_report(analytics: DataFrame) -> DataFrame:
    m = monthly_orders(analytics).withColumn(
        "previous_month_revenue", lag_previous("monthly_revenue", "order_month")
    )
    cur, prev = F.col("monthly_revenue"), F.col("previous_month_revenue")
    return m.select(
        F.year("order_month").alias("year"),
        F.month("order_month").alias("month_number"),
        month_name("order_month").alias("month_name"),
        "total_orders",
        cur.cast(DOUBLE).alias("monthly_revenue"),
        prev.cast(DOUBLE).alias("previous_month_revenue"),
        (cur - prev).cast(DOUBLE).alias("revenue_change"),
        growth_percentage(cents(cur), cents(prev)).alias("growth_percentage"),
        "order_month",
    ).orderBy("order_month").drop("order_month")


def state_summary(analytics: DataFrame) -> DataFrame:
    return (
        analytics.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.countDistinct("customer_id").alias("total_customers"),
            F.sum("revenue").alias("total_revenue"),
            _avg_money().alias("avg_order_value"),
            _avg_days().alias("avg_delivery_days"),
        )
    )


def state_performance_report(analytics: DataFrame) -> DataFrame:
    s = state_summary(analytics).withColumns({
        "revenue_rank": dense_rank_desc("total_revenue"),
        "revenue_quartile": ntile_desc(4, "total_revenue", "customer_state"),
    }).transform(share_of_total_window, cents("total_revenue"), "revenue_share_percentage")
    return s.select(
        "customer_state", "total_orders", "total_customers",
        F.col("total_revenue").cast(DOUBLE).alias("total_revenue"),
        "avg_order_value", "avg_delivery_days", "revenue_rank", "revenue_quartile",
        performance_tier("revenue_quartile").alias("performance_tier"),
        "revenue_share_percentage",
    ).orderBy("revenue_rank", "customer_state")


def daily_orders(analytics: DataFrame) -> DataFrame:
    """Orders and exact revenue per calendar day of purchase."""
    return (
        analytics.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(F.to_date("order_purchase_timestamp").alias("order_date"))
        .agg(F.count(F.lit(1)).alias("daily_orders"), F.sum("revenue").alias("daily_revenue"))
    )


def running_revenue_report(analytics: DataFrame) -> DataFrame:
    d = daily_orders(analytics).withColumns({
        "cumulative_revenue": running_sum("daily_revenue", "order_date"),
        "_total": F.sum("daily_revenue").over(Window.partitionBy()),
    }).transform(moving_average_rows, cents("daily_revenue"), "order_date",
                 "seven_day_avg_revenue", 7)
    return d.select(
        "order_date", "daily_orders",
        F.col("daily_revenue").cast(DOUBLE).alias("daily_revenue"),
        F.col("cumulative_revenue").cast(DOUBLE).alias("cumulative_revenue"),
        half_up_ratio(cents("cumulative_revenue") * 100, cents("_total"), 2)
        .alias("cumulative_revenue_percentage"),
        "seven_day_avg_revenue",
    ).orderBy("order_date")


def late_on_time_counts(view: DataFrame) -> DataFrame:
    late = F.sum(F.when(F.col("is_late") == F.lit(True), 1).otherwise(0))
    on_time = F.sum(F.when(F.col("is_late") == F.lit(False), 1).otherwise(0))
    return (
        view.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            _avg_days().alias("avg_delivery_days"),
            late.cast("bigint").alias("late_orders"),
            on_time.cast("bigint").alias("on_time_orders"),
        )
    )


def delivery_analysis_report(analytics: DataFrame) -> DataFrame:
    return (
        late_on_time_counts(delivery_view(analytics))
        .withColumn("late_delivery_percentage",
                    half_up_ratio(F.col("late_orders") * 100, F.col("delivered_orders"), 2))
        .orderBy(F.col("late_delivery_percentage").desc(), F.col("customer_state"))
    )


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "order_status": order_status_report,
    "monthly_revenue": monthly_revenue_report,
    "state_performance": state_performance_report,
    "running_revenue": running_revenue_report,
    "delivery_analysis": delivery_analysis_report,
}


def run_reports(analytics: DataFrame) -> dict[str, DataFrame]:
    """All reports over one analytics relation (cache it first when several
    reports are executed)."""
    return {name: fn(analytics) for name, fn in REPORTS.items()}


def long_form(name: str, report: DataFrame, keys: int = 1) -> DataFrame:
    """A report's values in one shape for all reports: report_name, row_key
    (its first ``keys`` columns as text), column_name, text_value,
    number_value."""
    columns = report.schema.fields
    key = F.concat_ws("|", *[F.col(f.name).cast("string") for f in columns[:keys]])

    def cell(f):
        text = isinstance(f.dataType, (T.StringType, T.DateType, T.BooleanType))
        return F.struct(
            F.lit(f.name).alias("column_name"),
            (F.col(f.name).cast("string") if text else F.lit(None).cast("string")).alias("text_value"),
            (F.lit(None).cast("double") if text else F.col(f.name).cast("double")).alias("number_value"))

    return report.select(F.lit(name).alias("report_name"), key.alias("row_key"),
                         F.inline(F.array(*[cell(f) for f in columns])))


#: Leading columns that tell a report's rows apart, where it is not just one.
KEY_COLUMNS = {"monthly_revenue": 2}
