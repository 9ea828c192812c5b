"""Business insights listed in the source pipeline's documentation.

Plain aggregations over the canonical tables; each pre-aggregates at the
item or payment grain with map-side combine before any join, and joins
dimensions only after reduction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions.scalars import cents, half_up_ratio
from cartwright.operators.clean import positive_payments
from cartwright.operators.joins import enrich_products
from cartwright.operators.windows import dense_rank_distributed, share_of_total_window


def kpi_totals(analytics: DataFrame) -> DataFrame:
    """Total orders, total revenue and average order value (one row)."""
    return analytics.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("revenue").alias("total_revenue"),
        F.sum(cents("revenue")).alias("_cents"),
        F.count("revenue").alias("_n"),
    ).select(
        "total_orders",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        half_up_ratio("_cents", F.col("_n") * 100, 2).alias("avg_order_value"),
    )


def product_sales(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("units_sold"),
        F.countDistinct("order_id").alias("orders"),
        F.sum("price").alias("revenue"),
    )


def top_products(items: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best-selling products by revenue (ties: smaller id first).
    ``orderBy + limit`` plans as a per-partition top-n, not a full sort."""
    return (
        product_sales(items)
        .orderBy(F.col("revenue").desc(), F.col("product_id"))
        .limit(n)
        .withColumn("revenue", F.col("revenue").cast("double"))
    )


def category_performance(items: DataFrame, products: DataFrame,
                         translation: DataFrame) -> DataFrame:
    """Items and revenue per product category (English name where known).
    Items are reduced to product grain before meeting the product table."""
    sales = product_sales(items).drop("orders")
    cat = enrich_products(products, translation).select(
        "product_id", "product_category_name", "product_category_name_english")
    return (
        sales.join(cat, "product_id", "left")
        .groupBy("product_category_name", "product_category_name_english")
        .agg(
            F.sum("units_sold").alias("items_sold"),
            F.count(F.lit(1)).alias("products"),
            F.sum("revenue").cast("double").alias("revenue"),
        )
    )


def customer_distribution(customers: DataFrame) -> DataFrame:
    """Distinct customers per state with their share of all customers."""
    per_state = customers.groupBy("customer_state").agg(
        F.countDistinct("customer_unique_id").alias("customers"))
    return per_state.transform(share_of_total_window, F.col("customers"), "customer_share_percentage")


def seller_performance(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """Per seller: items, distinct orders, revenue, freight, and a dense
    revenue rank.  Sellers grow with the data, so the rank is the
    range-partitioned form rather than a single-partition window."""
    per_seller = items.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("items_sold"),
        F.countDistinct("order_id").alias("orders"),
        F.sum("price").alias("revenue"),
        F.sum("freight_value").alias("freight"),
    )
    ranked = dense_rank_distributed(per_seller, "revenue", "revenue_rank")
    return ranked.join(sellers.select("seller_id", "seller_state"), "seller_id", "left").select(
        "seller_id", "seller_state", "items_sold", "orders",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("freight").cast("double").alias("freight"),
        "revenue_rank",
    )


def payment_mix(payments: DataFrame) -> DataFrame:
    """Positive payments per type: count, value and share of value."""
    per_type = positive_payments(payments).groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payments"),
        F.countDistinct("order_id").alias("orders"),
        F.sum("payment_value").alias("total_value"),
    )
    return per_type.transform(share_of_total_window, cents("total_value"), "value_share_percentage") \
        .withColumn("total_value", F.col("total_value").cast("double"))


def item_master(items: DataFrame, products: DataFrame, translation: DataFrame,
                sellers: DataFrame, master: DataFrame) -> DataFrame:
    """Item-grain table: each line with its product category, seller state
    and order attributes.  Items keep their grain; every other side is
    unique on its join key, so no join multiplies rows."""
    cat = enrich_products(products, translation).select(
        "product_id", "product_category_name", "product_category_name_english")
    orders = master.select("order_id", "order_status", "order_purchase_timestamp",
                           "customer_state", "is_late")
    return (
        items.join(orders, "order_id", "left")
        .join(cat, "product_id", "left")
        .join(sellers.select("seller_id", "seller_state"), "seller_id", "left")
        .select(
            "order_id", "order_item_id", "product_id", "seller_id",
            F.col("price").cast("double").alias("price"),
            F.col("freight_value").cast("double").alias("freight_value"),
            "product_category_name", "product_category_name_english", "seller_state",
            "order_status", "order_purchase_timestamp", "customer_state", "is_late",
        )
    )


def review_score_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score with their share, and how many carry a comment.
    (No review table exists in the test data; exercised by unit tests.)"""
    per_score = reviews.where(F.col("review_score").isNotNull()).groupBy("review_score").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(F.col("review_comment_message").isNotNull()).alias("with_comment"),
    )
    return per_score.transform(share_of_total_window, F.col("reviews"), "review_share_percentage")
