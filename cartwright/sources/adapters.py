"""Canonical commerce tables derived from the star-schema test tables.

The mapping (see FIXTURES.md §4) is plain projections, one aggregation of
line items per order and small dimension joins, so every canonical table
grows with its source.  All functions are lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions.scalars import MONEY

# Schemas of the star-schema test tables.  Declaring them
# skips the Parquet footer read that schema inference costs on every
# DataFrame construction (about 85 ms per table per query here).
TEST_TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TEST_TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _price(li: DataFrame):
    return li["l_extendedprice"].cast(MONEY)


def canonical_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders with carrier / customer delivery dates = first / last ship date
    of the order's lines (NULL for orders without lines) and an estimate
    60 days after purchase."""
    ship = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_shipdate").alias("order_delivered_carrier_date"),
        F.max("l_shipdate").alias("order_delivered_customer_date"),
    )
    base = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("order_estimated_delivery_date"),
    )
    return base.join(ship, "order_id", "left").select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )


def canonical_order_items(lineitem: DataFrame) -> DataFrame:
    price = _price(lineitem)
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY).alias("freight_value"),
    )


def canonical_payments(lineitem: DataFrame) -> DataFrame:
    """One payment per line; returned lines ('R') pay 0 so the positive-value
    filter has rows to remove.  Rounded per row to whole cents."""
    price = _price(lineitem)
    paid = F.round(price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2)
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(paid).cast(MONEY).alias("payment_value"),
    )


def canonical_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customer state = nation name.  The nation side is a fixed 25-row
    dimension; the planner broadcasts it from its own size estimate."""
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def canonical_products(part: DataFrame) -> DataFrame:
    """Category = part type; category and measures are NULL for every tenth
    size so the null fill has work to do."""
    missing = (F.col("p_size") % 10) == 0

    def unless_missing(c):
        return F.when(~missing, c)

    return part.select(
        F.col("p_partkey").alias("product_id"),
        unless_missing(F.col("p_type")).alias("product_category_name"),
        unless_missing(F.length("p_name")).cast("int").alias("product_name_lenght"),
        unless_missing(F.length("p_brand")).cast("int").alias("product_description_lenght"),
        unless_missing(F.col("p_size") % 5).cast("int").alias("product_photos_qty"),
        unless_missing(F.floor("p_retailprice")).cast("int").alias("product_weight_g"),
        unless_missing(F.col("p_size")).cast("int").alias("product_length_cm"),
        unless_missing(F.col("p_size") % 7).cast("int").alias("product_height_cm"),
        unless_missing(F.col("p_size") % 11).cast("int").alias("product_width_cm"),
    )


def canonical_category_translation(part: DataFrame) -> DataFrame:
    """Distinct part types with an upper-case 'English' name, minus the
    greatest type so that one category finds no translation."""
    greatest = part.agg(F.max("p_type")).scalar()
    return (
        part.select(F.col("p_type").alias("product_category_name"))
        .where(F.col("product_category_name") != greatest)
        .distinct()
        .select("product_category_name",
                F.upper("product_category_name").alias("product_category_name_english"))
    )


def canonical_sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


class CommerceTables:
    """The canonical tables of one test-data directory, built on first use.

    Each raw table is read at most once per instance and each canonical
    table is derived only when a query touches it, so a query pays the
    file-listing and footer reads of just the tables it needs.
    """

    NAMES = ("orders", "order_items", "customers", "products", "sellers", "payments",
             "category_translation")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._canon: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = read_table(self._spark, self._dir, name)
        return self._raw[name]

    def _build(self, name: str) -> DataFrame:
        r = self.raw
        if name == "orders":
            return canonical_orders(r("orders"), r("lineitem"))
        if name == "order_items":
            return canonical_order_items(r("lineitem"))
        if name == "customers":
            return canonical_customers(r("customer"), r("nation"))
        if name == "products":
            return canonical_products(r("part"))
        if name == "sellers":
            return canonical_sellers(r("supplier"), r("nation"))
        if name == "payments":
            return canonical_payments(r("lineitem"))
        if name == "category_translation":
            return canonical_category_translation(r("part"))
        raise KeyError(name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.NAMES:
            raise AttributeError(name)
        if name not in self._canon:
            self._canon[name] = self._build(name)
        return self._canon[name]

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self.NAMES}


def load_commerce(spark: SparkSession, sf_dir: str) -> CommerceTables:
    """Canonical tables for one test-data directory (lazy)."""
    return CommerceTables(spark, sf_dir)
