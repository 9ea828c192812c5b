"""Master build and the order-level analytics relation the reports read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions.columns import delivery_days_expr, is_late_expr, resolve_fields
from cartwright.functions.scalars import safe_cast, safe_timestamp
from cartwright.operators.aggregate import aggregate_items, aggregate_payments
from cartwright.operators.clean import clean_orders, dedup_by_key
from cartwright.operators.joins import build_master
from cartwright.sources.adapters import CommerceTables
from cartwright.sources.schemas import SUMMARY_COLUMNS

# Revenue stays an exact two-decimal value through every report sum.
REVENUE_TYPE = "decimal(28,2)"


def master_from_tables(t: CommerceTables) -> DataFrame:
    """Transform stage: clean orders, pre-aggregate items and payments, join."""
    return build_master(
        clean_orders(t.orders),
        aggregate_items(t.order_items),
        t.customers,
        aggregate_payments(t.payments),
    )


def orders_summary(master: DataFrame) -> DataFrame:
    """The ten-column order-grain extract."""
    return master.select(*SUMMARY_COLUMNS)


def canonical_projection(master: DataFrame) -> DataFrame:
    """Resolve logical fields against whatever columns ``master`` has and
    project them under canonical names and types (no filtering)."""
    f = resolve_fields(master)
    purchase = f["order_purchase_timestamp"]
    return master.select(
        F.col(f["order_id"]).alias("order_id"),
        F.col(f["customer_id"]).alias("customer_id"),
        F.col(f["order_status"]).alias("order_status"),
        safe_timestamp(purchase, master.schema[purchase].dataType).alias("order_purchase_timestamp"),
        F.col(f["customer_state"]).alias("customer_state"),
        safe_cast(f["revenue"], REVENUE_TYPE, master.schema[f["revenue"]].dataType).alias("revenue"),
        delivery_days_expr(master, f).alias("delivery_days"),
        is_late_expr(master, f).alias("is_late"),
    )


def analytics_orders(master: DataFrame, unique: bool = False) -> DataFrame:
    """Canonical order rows: non-NULL ``order_id``, one row per order.

    The NULL filter sits on the dedup key, so Catalyst pushes it below the
    aggregate and into the Parquet scan.  ``unique`` declares that the master
    has one row per order by construction, which skips the dedup and lets the
    optimizer drop whatever a report does not read; a persisted or foreign
    master makes no such promise.
    """
    rows = canonical_projection(master).where(F.col("order_id").isNotNull())
    return rows if unique else dedup_by_key(rows, ["order_id"])


def analytics_from_tables(t: CommerceTables) -> DataFrame:
    """Analytics orders straight from the source tables.  Orders, items and
    payments are at order grain; customers are reduced to one row per
    ``customer_id`` (hash-partitioned as the join needs them), so no join can
    repeat an order and no second dedup of whole order rows is needed."""
    one_each = dedup_by_key(t.customers, ["customer_id"], prefer=["customer_unique_id", "customer_state"])
    return analytics_orders(build_master(
        clean_orders(t.orders), aggregate_items(t.order_items), one_each, aggregate_payments(t.payments)), unique=True)


def delivery_view(analytics: DataFrame) -> DataFrame:
    """Delivered orders only (``delivery_days`` known)."""
    return analytics.select(
        "order_id", "customer_state", "order_status", "delivery_days", "is_late"
    ).where(F.col("delivery_days").isNotNull())


def register_views(spark: SparkSession, analytics: DataFrame) -> None:
    """Session views for SQL users: ``analytics_orders`` and
    ``delivery_analysis_vw`` (the latter defined in SQL over the former)."""
    analytics.createOrReplaceTempView("analytics_orders")
    spark.sql(
        "CREATE OR REPLACE TEMP VIEW delivery_analysis_vw AS "
        "SELECT order_id, customer_state, order_status, delivery_days, is_late "
        "FROM analytics_orders WHERE delivery_days IS NOT NULL"
    )
