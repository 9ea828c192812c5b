"""Join operators: dimension lookups and the master build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators.clean import fill_nulls
from cartwright.sources.schemas import MASTER_COLUMNS

def enrich_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Fill missing product attributes, then left-join the category
    translation (fill happens first, so 'unknown' finds no translation).

    The planner and AQE broadcast the translation only if its measured size
    is within ``spark.sql.autoBroadcastJoinThreshold``; beyond it the join
    shuffles.  Building the plan runs no job."""
    return fill_nulls(products).join(translation, "product_category_name", "left")


def orders_items_join(orders: DataFrame, items_summary: DataFrame) -> DataFrame:
    return orders.join(items_summary, "order_id", "left")


def orders_payments_join(orders: DataFrame, payment_summary: DataFrame) -> DataFrame:
    return orders.join(payment_summary, "order_id", "left")


def orders_customer_join(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id", "left")


def build_master(orders_clean: DataFrame, items_summary: DataFrame, customers: DataFrame,
                 payment_summary: DataFrame) -> DataFrame:
    """One row per order with item, payment and customer attributes.

    The two order-grain joins run first: cleaned orders, item summary and
    payment summary are all hash-partitioned on ``order_id`` by their own
    aggregations, so those joins add no exchange.  The customer join comes
    last and is the only re-shuffle of order rows (AQE splits a skewed hot
    customer, or converts to broadcast when the customer side is small).
    Missing money totals become 0; counts and the type set stay NULL.
    """
    master = orders_customer_join(
        orders_payments_join(orders_items_join(orders_clean, items_summary), payment_summary),
        customers,
    )
    master = master.withColumns({
        "order_total": F.coalesce(F.col("order_total"), F.lit(0)),
        "total_payment": F.coalesce(F.col("total_payment"), F.lit(0)),
    })
    return master.select(*MASTER_COLUMNS)
