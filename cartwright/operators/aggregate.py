"""Per-order pre-aggregates of the one-to-many sides.

Both are aggregated to the order grain *before* any join, so items and
payments never multiply each other, and both come out hash-partitioned on
``order_id`` for the master join to reuse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators.clean import positive_payments


def aggregate_payments(payments: DataFrame) -> DataFrame:
    """Per order: total of positive payments, their count and the sorted set
    of payment types (a set bounded by the number of types, combined
    map-side)."""
    return (
        positive_payments(payments)
        .groupBy("order_id")
        .agg(
            F.sum("payment_value").alias("total_payment"),
            F.count("payment_sequential").alias("payment_count"),
            F.sort_array(F.collect_set("payment_type")).alias("payment_types"),
        )
    )


def aggregate_items(items: DataFrame) -> DataFrame:
    """Per order: item count, item and freight totals, and their sum (NULL
    if either part is NULL)."""
    return (
        items.groupBy("order_id")
        .agg(
            F.count("order_item_id").alias("item_count"),
            F.sum("price").alias("items_total"),
            F.sum("freight_value").alias("freight_total"),
        )
        .withColumn("order_total", F.col("items_total") + F.col("freight_total"))
    )
