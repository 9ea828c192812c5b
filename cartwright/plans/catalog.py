"""Query catalog: one ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the test tables of ``sf_dir`` in full (through the
canonical adapter).  Outputs use stable types: money and ratios as double
(decimal inside), counts as bigint, calendar parts as int.  Queries that
exercise a sink write under the shared checkpoint folder, to a fresh path
per call, and return a frame that reads the written data back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.columns import delivery_days_expr, resolve_fields
from cartwright.functions.scalars import (
    MONEY, cents, half_up_ratio, late_flag, month_name, normalize_boolean, safe_cast,
)
from cartwright.operators import profile as P
from cartwright.operators import quality as Q
from cartwright.operators import windows as W
from cartwright.operators.aggregate import aggregate_items, aggregate_payments
from cartwright.operators.clean import (
    clean_column_names, clean_orders, dedup_by_key, derive_order_fields, fill_nulls,
    positive_payments, typed_timestamps,
)
from cartwright.operators.joins import (
    build_master, enrich_products, orders_customer_join, orders_items_join, orders_payments_join,
)
from cartwright.operators.prefix import ordered_windows
from cartwright.plans import insights as D
from cartwright.plans import reports as R
from cartwright.plans.analytics import (
    analytics_from_tables, canonical_projection, delivery_view, master_from_tables, orders_summary,
    register_views,
)
from cartwright.plans.sql_runner import run_sql_files
from cartwright.session import scratch_path
from cartwright.sinks import writers as K
from cartwright.sources import readers as S
from cartwright.sources.adapters import CommerceTables, load_commerce, read_table
from cartwright.sources.fs import path_exists
from cartwright.sources.heads import Heads, file_heads, group_heads
from cartwright.sources.schemas import (
    COUNTED_SOURCES, EXPECTED_COLUMNS, MASTER_COLUMNS, RAW_SCHEMAS, REQUIRED_INPUTS, SCHEMAS, SUMMARY_COLUMNS,
)

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        CATALOG[name] = fn
        return fn
    return register


def edge(df: DataFrame) -> DataFrame:
    """Decimals -> double for output (exact inside, double at the edge)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def _tables(spark: SparkSession, sf_dir: str) -> CommerceTables:
    return load_commerce(spark, sf_dir)


def _master(spark, sf_dir) -> DataFrame:
    return master_from_tables(_tables(spark, sf_dir))


def _analytics(spark, sf_dir) -> DataFrame:
    return analytics_from_tables(_tables(spark, sf_dir))


# ---------------------------------------------------------------- reports (R1-R6)

for _name, _fn in R.REPORTS.items():
    CATALOG[f"{_name}_report"] = (lambda fn: lambda spark, sf_dir: fn(_analytics(spark, sf_dir)))(_fn)


@query("orders_summary")
def q_orders_summary(spark, sf_dir):
    return edge(orders_summary(_master(spark, sf_dir)))


# ---------------------------------------------------------------- transform (P, F, A, J)

@query("typed_timestamps")
def q_typed_timestamps(spark, sf_dir):
    """Timestamps arriving as text; a pending order's approval text is not a
    date and must become NULL instead of failing the job."""
    o = _tables(spark, sf_dir).orders
    ts = [c for c in o.columns if c.startswith("order_") and c not in ("order_id", "order_status")]
    # cast(timestamp_ntz as string) renders the wall clock without a zone
    text = o.withColumns({c: F.col(c).cast("string") for c in ts}).withColumn(
        "order_approved_at",
        F.when(F.col("order_status") == "P", F.lit("pending approval")).otherwise(F.col("order_approved_at")),
    )
    return typed_timestamps(text).select("order_id", *ts)


@query("clean_orders")
def q_clean_orders(spark, sf_dir):
    return clean_orders(_tables(spark, sf_dir).orders)


@query("date_parts")
def q_date_parts(spark, sf_dir):
    o = derive_order_fields(_tables(spark, sf_dir).orders)
    return o.select("order_id", "purchase_year", "purchase_month", "purchase_day_of_week")


@query("date_diff_days")
def q_date_diff_days(spark, sf_dir):
    o = _tables(spark, sf_dir).orders
    return o.select("order_id", F.datediff("order_delivered_customer_date",
                                           "order_purchase_timestamp").alias("delivery_days"))


@query("late_flag")
def q_late_flag(spark, sf_dir):
    o = _tables(spark, sf_dir).orders
    return o.select("order_id", late_flag("order_delivered_customer_date",
                                          "order_estimated_delivery_date").alias("is_late"))


@query("dedup_orders")
def q_dedup_orders(spark, sf_dir):
    return dedup_by_key(_tables(spark, sf_dir).orders, ["order_id"])


@query("dedup_order_lines")
def q_dedup_order_lines(spark, sf_dir):
    """(order_id, order_item_id) repeats in the line data; keep the line with
    the greatest product, seller, date, price, freight."""
    return edge(dedup_by_key(_tables(spark, sf_dir).order_items, ["order_id", "order_item_id"]))


@query("fill_nulls")
def q_fill_nulls(spark, sf_dir):
    return fill_nulls(_tables(spark, sf_dir).products)


@query("enrich_products")
def q_enrich_products(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return enrich_products(t.products, t.category_translation)


@query("positive_payments")
def q_positive_payments(spark, sf_dir):
    return edge(positive_payments(_tables(spark, sf_dir).payments))


@query("aggregate_payments")
def q_aggregate_payments(spark, sf_dir):
    return edge(aggregate_payments(_tables(spark, sf_dir).payments))


@query("payment_types_set")
def q_payment_types_set(spark, sf_dir):
    return aggregate_payments(_tables(spark, sf_dir).payments).select("order_id", "payment_types")


@query("aggregate_items")
def q_aggregate_items(spark, sf_dir):
    return edge(aggregate_items(_tables(spark, sf_dir).order_items))


@query("orders_items_join")
def q_orders_items_join(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return edge(orders_items_join(clean_orders(t.orders), aggregate_items(t.order_items)))


@query("orders_payments_join")
def q_orders_payments_join(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return edge(orders_payments_join(clean_orders(t.orders), aggregate_payments(t.payments)))


@query("orders_customer_join")
def q_orders_customer_join(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return orders_customer_join(clean_orders(t.orders), t.customers)


@query("build_master")
def q_build_master(spark, sf_dir):
    return edge(_master(spark, sf_dir))


@query("analytics_orders")
def q_analytics_orders(spark, sf_dir):
    return edge(_analytics(spark, sf_dir))


def _renamed_master(spark, sf_dir) -> DataFrame:
    """A master written by another producer: different names, no
    ``total_payment`` / ``delivery_days``, and the late flag as text."""
    m = _master(spark, sf_dir)
    spelled = F.when(F.col("is_late"), F.lit(" Yes ")).otherwise(F.lit("n"))
    return m.select(
        "order_id", "customer_id", "order_status",
        F.col("order_purchase_timestamp").alias("purchase_timestamp"),
        F.col("customer_state").alias("state"), "order_total",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        spelled.alias("is_late"),
    )


@query("schema_resolve")
def q_schema_resolve(spark, sf_dir):
    """Resolve logical fields on a differently-named master: customer_id,
    purchase_timestamp, state, order_total (first revenue candidate present),
    delivery days derived from dates, late flag normalised from text."""
    return edge(canonical_projection(_renamed_master(spark, sf_dir)))


@query("derive_delivery_days")
def q_derive_delivery_days(spark, sf_dir):
    m = _renamed_master(spark, sf_dir)
    return m.select("order_id", delivery_days_expr(m, resolve_fields(m)).alias("delivery_days"))


@query("normalize_boolean")
def q_normalize_boolean(spark, sf_dir):
    """Heterogeneous flag text derived from order priority and status."""
    o = read_table(spark, sf_dir, "orders")
    pri, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    text = (
        F.when(pri.startswith("1"), F.lit("TRUE"))
        .when(pri.startswith("2"), F.lit(" yes "))
        .when(pri.startswith("3"), F.lit("0"))
        .when(pri.startswith("4"), F.when(st == "F", F.lit("F")).when(st == "O", F.lit("n")))
        .otherwise(F.lit("maybe"))
    )
    flags = o.select(F.col("o_orderkey").alias("order_id"), text.alias("flag_text"))
    return flags.withColumn("flag", normalize_boolean("flag_text", T.StringType()))


@query("safe_casts")
def q_safe_casts(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        safe_cast("l_returnflag", "int", T.StringType()).alias("flag_as_int"),
        safe_cast(F.col("l_linenumber").cast("string"), "int", T.StringType()).alias("line_as_int"),
        safe_cast("l_linestatus", "boolean", T.StringType()).alias("status_as_boolean"),
        safe_cast(F.col("l_tax").cast("string"), "double", T.StringType()).alias("tax_as_double"),
    )


@query("round_half_up")
def q_round_half_up(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(MONEY)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.round(price * F.col("l_discount").cast("decimal(4,2)"), 2).cast("double").alias("discount_amount"),
        F.round(price * F.col("l_tax").cast("decimal(4,2)"), 1).cast("double").alias("tax_amount_1dp"),
    )


@query("arithmetic_ops")
def q_arithmetic_ops(spark, sf_dir):
    """Decimal products and sums stay exact; a ratio with a zero divisor
    (lines without discount) is NULL rather than an error."""
    li = read_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(MONEY)
    points = (F.col("l_discount").cast("decimal(4,2)") * 100).cast("int")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        (price * F.col("l_quantity").cast(MONEY)).cast("double").alias("gross_value"),
        (price + F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2)).cast("double")
        .alias("price_with_freight"),
        half_up_ratio(cents(price), points * 100, 2).alias("price_per_discount_point"),
    )


@query("null_predicates")
def q_null_predicates(spark, sf_dir):
    m = _master(spark, sf_dir)
    delivered = F.col("order_delivered_customer_date")
    return m.agg(
        F.count_if(F.col("is_late") == F.lit(True)).alias("late_true"),
        F.count_if(F.col("is_late") == F.lit(False)).alias("late_false"),
        F.count_if(F.col("is_late").isNull()).alias("late_null"),
        F.count_if(delivered.isNull()).alias("undelivered"),
        F.count_if(delivered.isNotNull()).alias("delivered"),
        F.count_if(F.col("item_count").isNull() | F.col("payment_count").isNull())
        .alias("missing_items_or_payments"),
    )


# ---------------------------------------------------------------- aggregates and windows

@query("monthly_orders")
def q_monthly_orders(spark, sf_dir):
    m = R.monthly_orders(_analytics(spark, sf_dir))
    return edge(m.select(F.year("order_month").alias("year"),
                         F.month("order_month").alias("month_number"),
                         "total_orders", "monthly_revenue"))


@query("month_name")
def q_month_name(spark, sf_dir):
    m = R.monthly_orders(_analytics(spark, sf_dir))
    return m.select(F.year("order_month").alias("year"), F.month("order_month").alias("month_number"),
                    month_name("order_month").alias("month_name"))


@query("daily_orders")
def q_daily_orders(spark, sf_dir):
    return edge(R.daily_orders(_analytics(spark, sf_dir)))


@query("distinct_customers_by_state")
def q_distinct_customers(spark, sf_dir):
    return _analytics(spark, sf_dir).where(F.col("customer_state").isNotNull()) \
        .groupBy("customer_state").agg(F.countDistinct("customer_id").alias("total_customers"))


@query("late_on_time_counts")
def q_late_on_time(spark, sf_dir):
    return R.late_on_time_counts(delivery_view(_analytics(spark, sf_dir)))


@query("order_windows")
def q_order_windows(spark, sf_dir):
    """Running total, the order before and the average of seven orders over
    every order in the sequence of purchase: as many rows as orders."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").cast(MONEY).alias("price"))
    return ordered_windows(
        o, ["o_orderdate", "o_orderkey"], running_sums={"running_total": F.col("price")},
        lags={"previous_price": (F.col("price"), 1)}, moving_averages={"seven_order_avg": (cents("price"), 7)}).select(
        "o_orderkey", *[F.col(c).cast("double").alias(c) for c in ("price", "running_total", "previous_price")], "seven_order_avg")


@query("share_of_total")
def q_share_of_total(spark, sf_dir):
    """Each order's share of all revenue (row-level input: the total is a
    scalar subquery, no single-partition window)."""
    a = _analytics(spark, sf_dir).select("order_id", "revenue")
    return edge(W.share_of_total(a, "revenue", "revenue_share_percentage", is_money=True, scale=6))


@query("lag_month")
def q_lag_month(spark, sf_dir):
    r = R.monthly_revenue_report(_analytics(spark, sf_dir))
    return r.select("year", "month_number", "monthly_revenue", "previous_month_revenue")


@query("growth_pct")
def q_growth_pct(spark, sf_dir):
    r = R.monthly_revenue_report(_analytics(spark, sf_dir))
    return r.select("year", "month_number", "revenue_change", "growth_percentage")


@query("dense_rank_state")
def q_dense_rank_state(spark, sf_dir):
    s = R.state_summary(_analytics(spark, sf_dir))
    return edge(s.select("customer_state", "total_revenue",
                         W.dense_rank_desc("total_revenue").alias("revenue_rank")))


@query("ntile_state")
def q_ntile_state(spark, sf_dir):
    s = R.state_summary(_analytics(spark, sf_dir))
    return edge(s.select("customer_state", "total_revenue",
                         W.ntile_desc(4, "total_revenue", "customer_state").alias("revenue_quartile")))


@query("performance_tier")
def q_performance_tier(spark, sf_dir):
    r = R.state_performance_report(_analytics(spark, sf_dir))
    return r.select("customer_state", "revenue_quartile", "performance_tier")


@query("running_sum")
def q_running_sum(spark, sf_dir):
    d = R.daily_orders(_analytics(spark, sf_dir))
    return edge(d.select("order_date", "daily_revenue",
                         W.running_sum("daily_revenue", "order_date").alias("cumulative_revenue")))


@query("moving_avg_7")
def q_moving_avg_7(spark, sf_dir):
    d = R.daily_orders(_analytics(spark, sf_dir))
    return edge(W.moving_average_rows(d, cents("daily_revenue"), "order_date",
                                      "seven_day_avg_revenue", 7))


@query("moving_avg_7_calendar")
def q_moving_avg_7_calendar(spark, sf_dir):
    d = R.daily_orders(_analytics(spark, sf_dir))
    return edge(W.moving_average_days(d, cents("daily_revenue"), "order_date",
                                      "seven_calendar_day_avg_revenue", 7))


@query("delivery_analysis_view")
def q_delivery_view(spark, sf_dir):
    register_views(spark, _analytics(spark, sf_dir))
    return spark.sql("SELECT * FROM delivery_analysis_vw")


@query("run_reports")
def q_run_reports(spark, sf_dir):
    """Every value of every report, in long form."""
    reports = R.run_reports(_analytics(spark, sf_dir))
    return P.union_all([R.long_form(n, df, R.KEY_COLUMNS.get(n, 1)) for n, df in reports.items()])


@query("sql_file_reports")
def q_sql_file_reports(spark, sf_dir):
    """The packaged SQL files over the registered views, in long form."""
    found = run_sql_files(spark, _analytics(spark, sf_dir))
    return P.union_all([R.long_form(n, df) for n, df in sorted(found.items())])


@query("report_preview")
def q_report_preview(spark, sf_dir):
    return K.preview(R.running_revenue_report(_analytics(spark, sf_dir)), 20)


# ---------------------------------------------------------------- documented insights (D)

@query("kpi_totals")
def q_kpi_totals(spark, sf_dir):
    return D.kpi_totals(_analytics(spark, sf_dir))


@query("top_products")
def q_top_products(spark, sf_dir):
    return D.top_products(_tables(spark, sf_dir).order_items, 10)


@query("category_performance")
def q_category_performance(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return D.category_performance(t.order_items, t.products, t.category_translation)


@query("customer_distribution")
def q_customer_distribution(spark, sf_dir):
    return D.customer_distribution(_tables(spark, sf_dir).customers)


@query("seller_performance")
def q_seller_performance(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return D.seller_performance(t.order_items, t.sellers)


@query("payment_mix")
def q_payment_mix(spark, sf_dir):
    return D.payment_mix(_tables(spark, sf_dir).payments)


@query("clean_column_names")
def q_clean_column_names(spark, sf_dir):
    """Display-style headers (spaces, case, punctuation) back to snake_case."""
    o = read_table(spark, sf_dir, "orders")
    shown = o.toDF(*[" " + c.replace("_", " ").title() + "(raw) " for c in o.columns])
    return clean_column_names(shown)


@query("item_master")
def q_item_master(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return D.item_master(t.order_items, t.products, t.category_translation, t.sellers,
                         master_from_tables(t))


# ---------------------------------------------------------------- profiling (Q1-Q7, A14)

def _registry(spark, sf_dir) -> dict[str, DataFrame]:
    return _tables(spark, sf_dir).as_dict()


@query("null_counts")
def q_null_counts(spark, sf_dir):
    return P.union_all([P.column_stats(df, n, infer=False) for n, df in _registry(spark, sf_dir).items()]) \
        .select("table_name", "column_name", "null_count")


@query("null_percentage")
def q_null_percentage(spark, sf_dir):
    return P.union_all([P.column_stats(df, n, infer=False) for n, df in _registry(spark, sf_dir).items()]) \
        .select("table_name", "column_name", "null_percentage")


@query("column_types")
def q_column_types(spark, sf_dir):
    return P.union_all([P.column_stats(df, n) for n, df in _registry(spark, sf_dir).items()]) \
        .select("table_name", "position", "column_name", "data_type", "inferred_type")


@query("logical_bytes")
def q_logical_bytes(spark, sf_dir):
    stats = P.union_all([P.column_stats(df, n, infer=False) for n, df in _registry(spark, sf_dir).items()])
    return stats.groupBy("table_name").agg(F.sum("logical_bytes").cast("bigint").alias("logical_bytes"))


@query("table_shape")
def q_table_shape(spark, sf_dir):
    return P.union_all([P.schema_check(df, n, EXPECTED_COLUMNS[n])
                        for n, df in _registry(spark, sf_dir).items()]) \
        .select("table_name", "row_count", "column_count")


@query("duplicate_rows")
def q_duplicate_rows(spark, sf_dir):
    return P.union_all([
        P.duplicate_row_count(df).select(F.lit(n).alias("table_name"), "duplicate_rows")
        for n, df in _registry(spark, sf_dir).items()
    ])


@query("profile_table")
def q_profile_table(spark, sf_dir):
    return P.profile_table(_tables(spark, sf_dir).orders, "orders", EXPECTED_COLUMNS["orders"])


@query("profile_all_tables")
def q_profile_all_tables(spark, sf_dir):
    return P.profile_tables(_registry(spark, sf_dir), EXPECTED_COLUMNS)


# Raw test tables standing in for a source that does not follow the data
# dictionary: the schema check must report them invalid.
RAW_COUNTERPARTS = {"orders": "orders", "order_items": "lineitem", "customers": "customer",
                    "products": "part", "sellers": "supplier"}


def _retyped(t: CommerceTables) -> dict[str, DataFrame]:
    """Tables with every expected column, some of another type: ids and times
    as text that still fits, customer ids and line numbers as text that does
    not (for every seventh order), and prices in floating point."""
    seventh = F.col("order_id") % 7 == 0
    return {
        "orders": t.orders.withColumns({
            "order_id": F.col("order_id").cast("string"),
            "order_approved_at": F.col("order_approved_at").cast("string"),
            "customer_id": F.concat(F.when(seventh, F.lit("C")).otherwise(F.lit("")), F.col("customer_id").cast("string"))}),
        "order_items": t.order_items.withColumns({
            "order_item_id": F.concat(F.col("order_item_id").cast("string"), F.when(seventh, F.lit(".5")).otherwise(F.lit(""))),
            "price": F.col("price").cast("double")}),
    }


@query("schema_diff")
def q_schema_diff(spark, sf_dir):
    """Names and types: the canonical tables, raw ones that lack the names, and
    ones with all names whose values no longer fit their types."""
    cols = ["table_name", "row_count", "schema_valid", "missing_columns", "extra_columns", "types_valid", "type_mismatches"]
    sources = {
        "canonical": _registry(spark, sf_dir),
        "raw": {n: read_table(spark, sf_dir, raw) for n, raw in RAW_COUNTERPARTS.items()},
        "retyped": _retyped(_tables(spark, sf_dir)),
    }
    return P.union_all([
        P.schema_check(df, n, EXPECTED_COLUMNS[n], types=SCHEMAS[n]).select(F.lit(source).alias("source"), *cols)
        for source, tables in sources.items() for n, df in tables.items()])


# ---------------------------------------------------------------- data quality (Q8-Q11, Q16)

def _dq_datasets(spark, sf_dir) -> dict[str, tuple]:
    """Dataset: frame, keys, required columns.  The last three break rules: a
    source that does not follow the data dictionary, approvals that were never
    filled in, and a status that no order has."""
    t = _tables(spark, sf_dir)
    order = ("order_id", "order_status")
    unapproved = t.orders.withColumn("order_approved_at", F.when(F.col("order_id") < 0, F.col("order_approved_at")))
    return {
        "master_orders": (master_from_tables(t), ["order_id"], order),
        "order_items": (t.order_items, ["order_id", "order_item_id"], ("order_id", "order_item_id")),
        "raw_orders": (read_table(spark, sf_dir, "orders"), ["order_id"], order),
        "unapproved_orders": (unapproved, ["order_id"], (*order, "order_approved_at")),
        "lost_orders": (t.orders.where(F.col("order_status") == "lost"), ["order_id"], order),
    }


def _dq(spark, sf_dir, rules=Q.RULES) -> DataFrame:
    return P.union_all([
        Q.dq_report(df, keys, required, rules).select(F.lit(name).alias("dataset"), "*")
        for name, (df, keys, required) in _dq_datasets(spark, sf_dir).items()])


@query("dq_report")
def q_dq_report(spark, sf_dir):
    return _dq(spark, sf_dir)


@query("dq_required_columns")
def q_dq_required(spark, sf_dir):
    return _dq(spark, sf_dir, ["required_columns", "filled_columns"])


@query("dq_non_empty")
def q_dq_non_empty(spark, sf_dir):
    return _dq(spark, sf_dir, ["non_empty"])


@query("null_key_count")
def q_null_key_count(spark, sf_dir):
    m = _master(spark, sf_dir)
    return Q.null_key_count(m, "order_id")


@query("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    """Repeated (order_id, order_item_id) line keys with their counts."""
    return Q.duplicate_keys(_tables(spark, sf_dir).order_items, ["order_id", "order_item_id"])


@query("output_contract")
def q_output_contract(spark, sf_dir):
    """The master, written as it is, and one written with another state for
    its first order: as many rows of the same schema, which must not pass.
    The master is built once: what is published has been read back and holds
    the master's rows, so the second output starts from it."""
    master, path = _master(spark, sf_dir), scratch_path(spark, "master_orders")
    whole = K.write_with_contract(master, path, "master_orders", ("purchase_year", "purchase_month"))
    if whole.first()["passed"]:
        master = spark.read.schema(master.schema).parquet(path).select(*master.columns)
    first = master.agg(F.min("order_id")).scalar()
    state = F.when(F.col("order_id") == first, F.concat(F.coalesce("customer_state", F.lit("")), F.lit("?"))).otherwise(
        F.col("customer_state"))
    return whole.union(
        K.write_with_contract(master, scratch_path(spark, "changed_orders"), "changed_orders",
                              write=lambda df, to: df.withColumn("customer_state", state).write.parquet(to)))


# ---------------------------------------------------------------- sources and sinks (S, K)

@query("source_row_counts")
def q_source_row_counts(spark, sf_dir):
    reg = _registry(spark, sf_dir)
    return P.union_all([
        reg[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in COUNTED_SOURCES
    ])


def _write_registry_csv(spark, sf_dir) -> dict[str, str]:
    """The canonical tables as a CSV drop under the shared scratch folder."""
    root = scratch_path(spark, "raw_csv")
    paths = {}
    for name, df in _registry(spark, sf_dir).items():
        paths[name] = f"{root}/{name}"
        K.write_csv(df, paths[name])
    return paths


@query("scan_csv_roundtrip")
def q_scan_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "orders_csv")
    K.write_csv(_tables(spark, sf_dir).orders, path)
    return S.read_csv_typed(spark, path, SCHEMAS["orders"])


@query("csv_header_binding")
def q_csv_header_binding(spark, sf_dir):
    """A seller drop whose header is in another order, lacks the zip prefix
    and has a column of its own: values must come by name, and the scan must
    say what the header lacks and has besides."""
    sellers = _tables(spark, sf_dir).sellers
    path = scratch_path(spark, "sellers_csv")
    K.write_csv(sellers.select(
        "seller_state", F.concat(F.lit("x"), F.col("seller_id").cast("string")).alias("seller_note"), "seller_city",
        "seller_id"), path)
    scan = S.tolerant_scan(spark, "sellers", path, SCHEMAS["sellers"])
    valid, _, _ = P.schema_diff(scan.header, EXPECTED_COLUMNS["sellers"])
    return scan.frame.drop(S.CORRUPT).select(
        "*", F.lit(scan.status).alias("status"), F.lit(valid).alias("schema_valid"),
        F.lit(",".join(scan.header)).alias("header"), F.lit(",".join(scan.missing_columns)).alias("missing_columns"),
        F.lit(",".join(scan.extra_columns)).alias("extra_columns"))


@query("empty_fields")
def q_empty_fields(spark, sf_dir):
    """Empty CSV fields per written table (NULLs are written as empty)."""
    scans = S.tolerant_scans(spark, _write_registry_csv(spark, sf_dir), SCHEMAS)
    frames = []
    for name, scan in scans.items():
        df = scan.frame.drop(S.CORRUPT)
        total = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
        frames.append(df.agg(F.sum(total).alias("empty_fields")).select(
            F.lit(name).alias("table_name"), F.coalesce("empty_fields", F.lit(0)).cast("bigint")
            .alias("empty_fields")))
    return P.union_all(frames)


def _write_lines(df: DataFrame, path: str, header: list[str], line_end: str) -> None:
    """CSV files with a header and line ends of one's own, each file with its header."""
    line = F.to_csv(F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(df.columns)]))
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0     # of its partition, and so of its file
    df.select(F.when(first, F.concat(F.lit(",".join(header) + line_end), line)).otherwise(line).alias("value")) \
        .write.option("lineSep", line_end).text(path)


def _write_hard_drop(spark, sf_dir) -> dict[str, str]:
    """A drop as it should not be.  Every third customer lies in files whose
    header has another order, the sellers' lines end in CR LF, the products'
    header has a name twice, the orders have files without a line, reviews is
    such a file only and there is no geolocation."""
    t, root = _tables(spark, sf_dir), scratch_path(spark, "hard_csv")
    paths = {name: f"{root}/{name}" for name in REQUIRED_INPUTS}
    for name in ("orders", "order_items", "payments", "category_translation"):
        K.write_csv(getattr(t, name), paths[name])
    third = F.col("customer_id") % 3 == 0
    K.write_csv(t.customers.where(~third), paths["customers"])
    t.customers.where(third).select(*reversed(t.customers.columns)).write.mode("append").option("header", True).csv(
        paths["customers"])
    _write_lines(t.sellers, paths["sellers"], t.sellers.columns, "\r\n")
    twice = F.col("product_weight_g") + 1
    _write_lines(t.products.withColumn("again", twice), paths["products"], [*t.products.columns, "product_weight_g"], "\n")
    none = spark.range(0).select(F.lit("").alias("value"))
    none.write.mode("append").text(paths["orders"])
    none.write.text(paths["reviews"])
    return paths


def _scans(spark, sf_dir) -> dict[str, S.ScanResult]:
    """All data-dictionary inputs of the hard drop, in which moreover one row
    of the order items is too long."""
    paths = _write_hard_drop(spark, sf_dir)
    broken = spark.range(1).select(F.lit("1,1,1,1,1996-01-01T00:00:00.000,1.00,1.00,one field too many").alias("value"))
    header = spark.range(1).select(F.lit(",".join(SCHEMAS["order_items"].names)).alias("value"))
    header.unionByName(broken).coalesce(1).write.mode("append").text(paths["order_items"])
    return S.tolerant_scans(spark, paths, {**RAW_SCHEMAS, **SCHEMAS})


@query("tolerant_scan")
def q_tolerant_scan(spark, sf_dir):
    """Status, header groups, names that occur twice, rows, rows that the
    parser could not fit and rows with NULLs of every input; absent and empty
    ones are reported instead of failing the scan."""
    frames = []
    for name, scan in _scans(spark, sf_dir).items():
        said = [F.lit(name).alias("table_name"), F.lit(scan.status).alias("status"),
                F.lit(len(scan.heads.groups)).cast("bigint").alias("header_groups"),
                F.lit(",".join(scan.duplicate_columns)).alias("duplicate_columns")]
        if scan.frame is None:
            none = F.lit(0).cast("bigint")
            frames.append(spark.range(1).select(*said, none.alias("row_count"), none.alias("corrupt_rows"),
                                                none.alias("rows_with_nulls")))
        else:
            any_null = F.lit(False)
            for c in scan.frame.columns:
                if c != S.CORRUPT:
                    any_null = any_null | F.col(c).isNull()
            frames.append(scan.frame.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count(S.CORRUPT).alias("corrupt_rows"),
                F.count_if(any_null).alias("rows_with_nulls")).select(
                *said, "row_count", "corrupt_rows", "rows_with_nulls"))
    return P.union_all(frames)


@query("input_completeness")
def q_input_completeness(spark, sf_dir):
    """Which required inputs storage holds, readable and with rows."""
    frames = []
    for name, scan in _scans(spark, sf_dir).items():
        counted = (scan.frame if scan.frame is not None else spark.range(0)).agg(F.count(F.lit(1)).alias("row_count"))
        frames.append(counted.select(
            F.lit(name).alias("table_name"), F.lit(scan.status != "missing").alias("present"),
            (F.lit(scan.status == "loaded") & (F.col("row_count") > 0)).alias("complete"), "row_count"))
    return P.union_all(frames)


@query("text_profile")
def q_text_profile(spark, sf_dir):
    """Per table of the hard drop: records (CSV-aware), line-based data rows,
    header of the most files' bytes, headers in use and the bytes without
    headers, whatever the line ends.  Only values that do not depend on how the
    writer split the files; the heads are all that is read while building."""
    frames = []
    for name, path in _write_hard_drop(spark, sf_dir).items():
        heads = group_heads(file_heads(spark, path)) if path_exists(spark, path) else Heads()
        files = [f for g in heads.groups for f in g.files]
        header = heads.groups[0].header if files else ()
        records = S.group_records(spark, heads, path, name in S.MULTILINE_TABLES).scalar() if files else F.lit(0)
        lines = S.text_lines(spark, path).agg(F.count(F.lit(1))).scalar() if files else F.lit(0)
        frames.append(spark.range(1).select(
            F.lit(name).alias("table_name"), records.cast("bigint").alias("records"),
            (lines - len(files)).cast("bigint").alias("line_rows"), F.lit(len(header)).alias("header_columns"),
            F.lit(",".join(header)).alias("header"), F.lit(len(heads.groups)).cast("bigint").alias("header_groups"),
            F.lit(sum(f.size - f.head_bytes for f in files)).cast("bigint").alias("data_bytes")))
    return P.union_all(frames)


@query("master_parquet_roundtrip")
def q_master_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "master_orders")
    K.write_parquet(_master(spark, sf_dir), path, ("purchase_year", "purchase_month"))
    back = spark.read.parquet(path)
    return edge(back.withColumns({
        "purchase_year": F.col("purchase_year").cast("int"),
        "purchase_month": F.col("purchase_month").cast("int"),
    }).select(*MASTER_COLUMNS))


@query("report_csv_roundtrip")
def q_report_csv_roundtrip(spark, sf_dir):
    """Every value of the report CSVs, read back, in long form."""
    root = scratch_path(spark, "reports")
    frames = []
    analytics = _analytics(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, df in R.run_reports(analytics).items():
            back = S.read_csv_typed(spark, K.write_report(df, root, name), df.schema)
            frames.append(R.long_form(name, back, R.KEY_COLUMNS.get(name, 1)))
    finally:
        analytics.unpersist()
    return P.union_all(frames)


@query("orders_summary_csv")
def q_orders_summary_csv(spark, sf_dir):
    """The order summary as the transform writes it, read back."""
    summary = orders_summary(_master(spark, sf_dir))
    path = scratch_path(spark, "orders_summary")
    K.write_csv(summary, path)
    return edge(S.read_csv_typed(spark, path, summary.schema).select(*SUMMARY_COLUMNS))


@query("profile_json")
def q_profile_json(spark, sf_dir):
    path = scratch_path(spark, "profile_json")
    profile = P.profile_tables(_registry(spark, sf_dir), EXPECTED_COLUMNS, columns=True)
    K.write_json(profile, path)
    back = spark.read.schema(profile.schema).json(path)
    # maps as sorted "name=value" lists, which compare alike everywhere
    return back.withColumns({
        name: F.array_sort(F.transform(F.map_entries(name), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))))
        for _, name in P.COLUMN_MAPS})
