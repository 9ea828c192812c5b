"""DuckDB oracle SQL for every query key in ``__spark_entry__.queries()``.

Each statement runs against the raw test tables (pre-registered views),
restates the canonical mapping as CTEs and spells out the column names, types
and patterns it checks, so the oracle imports nothing of the library.  Money is DECIMAL; rounded ratios use exact integer
division (HALF_UP), mirroring the Spark operators' semantics.
"""

from __future__ import annotations


def hu(num: str, den: str, scale: int = 2) -> str:
    """round(num / den, scale) HALF_UP on the exact quotient; NULL if den = 0."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return (
        f"(CASE WHEN {d} <> 0 THEN CAST((CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
        f" * ((abs({n}) * {2 * 10 ** scale} + abs({d})) // (2 * abs({d}))) AS DOUBLE)"
        f" / {10 ** scale}.0 END)"
    )


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"

CANON = f"""
c_ship AS (
  SELECT l_orderkey AS order_id, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
c_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         o_orderdate AS order_purchase_timestamp, o_orderdate AS order_approved_at,
         s.first_ship AS order_delivered_carrier_date, s.last_ship AS order_delivered_customer_date,
         o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date
  FROM orders LEFT JOIN c_ship s ON o_orderkey = s.order_id),
c_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, {PRICE} AS price,
         CAST(ROUND({PRICE} * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS freight_value
  FROM lineitem),
c_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
         CAST(trunc(l_quantity) AS INTEGER) AS payment_installments,
         CAST(CASE WHEN l_returnflag = 'R' THEN 0
                   ELSE ROUND({PRICE} * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) END
              AS DECIMAL(18,2)) AS payment_value
  FROM lineitem),
c_customers AS (
  SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
         c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city,
         n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
c_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_size % 10 <> 0 THEN p_type END AS product_category_name,
         CASE WHEN p_size % 10 <> 0 THEN CAST(length(p_name) AS INTEGER) END AS product_name_lenght,
         CASE WHEN p_size % 10 <> 0 THEN CAST(length(p_brand) AS INTEGER) END AS product_description_lenght,
         CASE WHEN p_size % 10 <> 0 THEN CAST(p_size % 5 AS INTEGER) END AS product_photos_qty,
         CASE WHEN p_size % 10 <> 0 THEN CAST(floor(p_retailprice) AS INTEGER) END AS product_weight_g,
         CASE WHEN p_size % 10 <> 0 THEN CAST(p_size AS INTEGER) END AS product_length_cm,
         CASE WHEN p_size % 10 <> 0 THEN CAST(p_size % 7 AS INTEGER) END AS product_height_cm,
         CASE WHEN p_size % 10 <> 0 THEN CAST(p_size % 11 AS INTEGER) END AS product_width_cm
  FROM part),
c_translation AS (
  SELECT DISTINCT p_type AS product_category_name, upper(p_type) AS product_category_name_english
  FROM part WHERE p_type <> (SELECT max(p_type) FROM part)),
c_sellers AS (
  SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, s_name AS seller_city,
         n_name AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
c_clean_orders AS (
  SELECT *,
         CAST(year(order_purchase_timestamp) AS INTEGER) AS purchase_year,
         CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month,
         CAST(dayofweek(order_purchase_timestamp) + 1 AS INTEGER) AS purchase_day_of_week,
         CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                        CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_days,
         COALESCE(order_delivered_customer_date > order_estimated_delivery_date, false) AS is_late
  FROM c_orders
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY
      customer_id DESC NULLS LAST, order_status DESC NULLS LAST,
      order_purchase_timestamp DESC NULLS LAST, order_approved_at DESC NULLS LAST,
      order_delivered_carrier_date DESC NULLS LAST, order_delivered_customer_date DESC NULLS LAST,
      order_estimated_delivery_date DESC NULLS LAST) = 1),
c_items_summary AS (
  SELECT order_id, count(order_item_id) AS item_count, sum(price) AS items_total,
         sum(freight_value) AS freight_total, sum(price) + sum(freight_value) AS order_total
  FROM c_items GROUP BY order_id),
c_payment_summary AS (
  SELECT order_id, sum(payment_value) AS total_payment, count(payment_sequential) AS payment_count,
         list_sort(list(DISTINCT payment_type)) AS payment_types
  FROM c_payments WHERE payment_value > 0 GROUP BY order_id),
c_master AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
         o.order_delivered_carrier_date, o.order_delivered_customer_date,
         o.order_estimated_delivery_date, o.purchase_year, o.purchase_month,
         o.purchase_day_of_week, o.delivery_days, o.is_late, i.item_count, i.items_total,
         i.freight_total, COALESCE(i.order_total, 0) AS order_total, c.customer_unique_id,
         c.customer_zip_code_prefix, c.customer_city, c.customer_state,
         COALESCE(p.total_payment, 0) AS total_payment, p.payment_count, p.payment_types
  FROM c_clean_orders o
  LEFT JOIN c_items_summary i ON o.order_id = i.order_id
  LEFT JOIN c_payment_summary p ON o.order_id = p.order_id
  LEFT JOIN c_customers c ON o.customer_id = c.customer_id),
c_analytics AS (
  SELECT order_id, customer_unique_id AS customer_id, order_status, order_purchase_timestamp,
         customer_state, CAST(total_payment AS DECIMAL(28,2)) AS revenue, delivery_days, is_late
  FROM c_master WHERE order_id IS NOT NULL),
c_monthly AS (
  SELECT date_trunc('month', order_purchase_timestamp) AS order_month, count(*) AS total_orders,
         sum(revenue) AS monthly_revenue
  FROM c_analytics WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1),
c_daily AS (
  SELECT CAST(order_purchase_timestamp AS DATE) AS order_date, count(*) AS daily_orders,
         sum(revenue) AS daily_revenue
  FROM c_analytics WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1),
c_state AS (
  SELECT customer_state, count(*) AS total_orders, count(DISTINCT customer_id) AS total_customers,
         sum(revenue) AS total_revenue,
         {hu(f"sum({cents('revenue')})", "count(revenue) * 100")} AS avg_order_value,
         {hu("sum(delivery_days)", "count(delivery_days)")} AS avg_delivery_days
  FROM c_analytics WHERE customer_state IS NOT NULL GROUP BY customer_state),
c_delivery_vw AS (
  SELECT order_id, customer_state, order_status, delivery_days, is_late
  FROM c_analytics WHERE delivery_days IS NOT NULL)
"""


def with_canon(body: str) -> str:
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + CANON.strip() + ",\n" + body[5:]
    return "WITH " + CANON.strip() + "\n" + body


ORDER_STATUS = f"""
SELECT order_status, CAST(total_orders AS BIGINT) AS total_orders,
       {hu("total_orders * 100", "sum(total_orders) OVER ()")} AS order_percentage
FROM (SELECT order_status, count(*) AS total_orders FROM c_analytics GROUP BY order_status)
"""

MONTHLY_REVENUE = f"""
SELECT CAST(year(order_month) AS INTEGER) AS year, CAST(month(order_month) AS INTEGER) AS month_number,
       monthname(order_month) AS month_name, CAST(total_orders AS BIGINT) AS total_orders,
       CAST(monthly_revenue AS DOUBLE) AS monthly_revenue,
       CAST(prev AS DOUBLE) AS previous_month_revenue,
       CAST(monthly_revenue - prev AS DOUBLE) AS revenue_change,
       {hu(f"({cents('monthly_revenue')} - {cents('prev')}) * 100", cents('prev'))} AS growth_percentage
FROM (SELECT *, lag(monthly_revenue) OVER (ORDER BY order_month) AS prev FROM c_monthly)
"""

STATE_PERFORMANCE = f"""
SELECT customer_state, CAST(total_orders AS BIGINT) AS total_orders,
       CAST(total_customers AS BIGINT) AS total_customers,
       CAST(total_revenue AS DOUBLE) AS total_revenue, avg_order_value, avg_delivery_days,
       CAST(dense_rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank,
       CAST(q AS INTEGER) AS revenue_quartile,
       CASE WHEN q = 1 THEN 'Top Performing' WHEN q = 2 THEN 'High Performing'
            WHEN q = 3 THEN 'Medium Performing' ELSE 'Low Performing' END AS performance_tier,
       {hu(f"{cents('total_revenue')} * 100", f"sum({cents('total_revenue')}) OVER ()")}
         AS revenue_share_percentage
FROM (SELECT *, ntile(4) OVER (ORDER BY total_revenue DESC, customer_state) AS q FROM c_state)
"""

RUNNING_REVENUE = f"""
SELECT order_date, CAST(daily_orders AS BIGINT) AS daily_orders,
       CAST(daily_revenue AS DOUBLE) AS daily_revenue, CAST(cum AS DOUBLE) AS cumulative_revenue,
       {hu(f"{cents('cum')} * 100", cents('total'))} AS cumulative_revenue_percentage,
       {hu("s7", "n7 * 100")} AS seven_day_avg_revenue
FROM (SELECT *,
        sum(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
        sum(daily_revenue) OVER () AS total,
        sum({cents('daily_revenue')}) OVER (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s7,
        count(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n7
      FROM c_daily)
"""

LATE_COUNTS = f"""
SELECT customer_state, CAST(count(*) AS BIGINT) AS delivered_orders,
       {hu("sum(delivery_days)", "count(delivery_days)")} AS avg_delivery_days,
       CAST(sum(CASE WHEN is_late = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS late_orders,
       CAST(sum(CASE WHEN is_late = FALSE THEN 1 ELSE 0 END) AS BIGINT) AS on_time_orders
FROM c_delivery_vw WHERE customer_state IS NOT NULL GROUP BY customer_state
"""

DELIVERY_ANALYSIS = f"""
SELECT *, {hu("late_orders * 100", "delivered_orders")} AS late_delivery_percentage
FROM ({LATE_COUNTS})
"""


def _cols(table: str, cols: list[str]) -> str:
    return ", ".join(cols)


MASTER_MONEY = """order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
  order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
  purchase_year, purchase_month, purchase_day_of_week, delivery_days, is_late, item_count,
  CAST(items_total AS DOUBLE) AS items_total, CAST(freight_total AS DOUBLE) AS freight_total,
  CAST(order_total AS DOUBLE) AS order_total, customer_unique_id, customer_zip_code_prefix,
  customer_city, customer_state, CAST(total_payment AS DOUBLE) AS total_payment, payment_count,
  payment_types"""

CLEAN_ORDER_COLS = """o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
  o.order_approved_at, o.order_delivered_carrier_date, o.order_delivered_customer_date,
  o.order_estimated_delivery_date, o.purchase_year, o.purchase_month, o.purchase_day_of_week,
  o.delivery_days, o.is_late"""

FILLED_PRODUCTS = """SELECT product_id, COALESCE(product_category_name, 'unknown') AS product_category_name,
  product_name_lenght, product_description_lenght, COALESCE(product_photos_qty, 0) AS product_photos_qty,
  COALESCE(product_weight_g, 0) AS product_weight_g, COALESCE(product_length_cm, 0) AS product_length_cm,
  COALESCE(product_height_cm, 0) AS product_height_cm, COALESCE(product_width_cm, 0) AS product_width_cm
  FROM c_products"""

ENRICHED = f"""SELECT f.product_category_name, f.product_id, f.product_name_lenght,
  f.product_description_lenght, f.product_photos_qty, f.product_weight_g, f.product_length_cm,
  f.product_height_cm, f.product_width_cm, t.product_category_name_english
  FROM ({FILLED_PRODUCTS}) f LEFT JOIN c_translation t ON f.product_category_name = t.product_category_name"""

PRODUCT_SALES = """SELECT product_id, count(*) AS units_sold, count(DISTINCT order_id) AS orders,
  sum(price) AS revenue FROM c_items GROUP BY product_id"""

REGISTRY = ["orders", "order_items", "customers", "products", "sellers", "payments",
            "category_translation"]
CANON_VIEW = {"orders": "c_orders", "order_items": "c_items", "customers": "c_customers",
              "products": "c_products", "sellers": "c_sellers", "payments": "c_payments",
              "category_translation": "c_translation"}


# What the canonical tables must look like.
TYPES = {
    "orders": "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp_ntz, "
              "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
              "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "order_items": "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, "
                   "shipping_limit_date timestamp_ntz, price decimal(18.2), freight_value decimal(18.2)",
    "customers": "customer_id bigint, customer_unique_id bigint, customer_zip_code_prefix int, customer_city string, "
                 "customer_state string",
    "products": "product_id bigint, product_category_name string, product_name_lenght int, "
                "product_description_lenght int, product_photos_qty int, product_weight_g int, product_length_cm int, "
                "product_height_cm int, product_width_cm int",
    "sellers": "seller_id bigint, seller_zip_code_prefix int, seller_city string, seller_state string",
    "payments": "order_id bigint, payment_sequential int, payment_type string, payment_installments int, "
                "payment_value decimal(18.2)",
    "category_translation": "product_category_name string, product_category_name_english string",
}
COLUMNS = {t: [tuple(c.replace("(18.2)", "(18,2)").split(" ", 1)) for c in cols.split(", ")]
           for t, cols in TYPES.items()}
ALL_INPUTS = ["orders", "order_items", "customers", "products", "sellers", "payments", "reviews", "geolocation",
              "category_translation"]

# The text forms that make a column's inferred type.
FORMS = (
    ("bigint", "[+-]?[0-9]{1,18}"),
    ("double", "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"),
    ("timestamp", "[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\\.[0-9]+)?)?)?"),
    ("boolean", "([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])"),
)


def _inferred_type(col: str) -> str:
    text = f"CAST({col} AS VARCHAR)"
    cases = " ".join(f"WHEN bool_and(regexp_full_match({text}, '{form}')) THEN '{kind}'" for kind, form in FORMS)
    return f"CASE WHEN count({col}) = 0 THEN 'void' {cases} ELSE 'string' END"


def _width(type_name: str, col: str) -> str:
    if type_name == "string":
        return f"COALESCE(strlen({col}), 0)"
    w = {"int": 4, "bigint": 8, "double": 8, "timestamp_ntz": 8, "boolean": 1, "date": 4}.get(type_name, 8)
    return f"(CASE WHEN {col} IS NULL THEN 0 ELSE {w} END)"


def _column_stats() -> str:
    """UNION of one row per (table, column): null_count, row_count, bytes."""
    parts = []
    for t in REGISTRY:
        for pos, (name, kind) in enumerate(COLUMNS[t], start=1):
            parts.append(
                f"SELECT '{t}' AS table_name, {pos} AS position, '{name}' AS column_name, "
                f"'{kind}' AS data_type, {_inferred_type(name)} AS inferred_type, "
                f"CAST(count(*) AS BIGINT) AS row_count, "
                f"CAST(count(*) FILTER (WHERE {name} IS NULL) AS BIGINT) AS null_count, "
                f"CAST(sum({_width(kind, name)}) AS BIGINT) AS logical_bytes "
                f"FROM {CANON_VIEW[t]}")
    return "\nUNION ALL ".join(parts)


def _dups(view: str) -> str:
    return f"(SELECT count(*) FROM {view}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {view}))"


def _profile_rows(maps: bool = False) -> str:
    def pairs(value: str, name: str) -> str:
        return f", list_sort(list(column_name || '=' || {value})) AS {name}"

    per_column = "".join(pairs(f"CAST({c} AS VARCHAR)", n) for c, n in (
        ("data_type", "data_types"), ("inferred_type", "inferred_types"), ("null_count", "null_counts"),
        (hu("null_count * 100", "row_count"), "null_percentages"))) if maps else ""
    parts = []
    for t in REGISTRY:
        names = ",".join(name for name, _ in COLUMNS[t])
        parts.append(
            f"SELECT '{t}' AS table_name, CAST(max(row_count) AS BIGINT) AS row_count, "
            f"CAST(count(*) AS BIGINT) AS column_count, '{names}' AS column_names, "
            f"CAST(sum(null_count) AS BIGINT) AS null_cells, CAST(sum(logical_bytes) AS BIGINT) AS logical_bytes, "
            f"CAST(({_dups(CANON_VIEW[t])}) AS BIGINT) AS duplicate_rows, true AS schema_valid, "
            f"CAST([] AS VARCHAR[]) AS missing_columns, CAST([] AS VARCHAR[]) AS extra_columns{per_column} "
            f"FROM cs WHERE table_name = '{t}'")
    return "\nUNION ALL ".join(parts)


RAW_COUNTERPARTS = {"orders": "orders", "order_items": "lineitem", "customers": "customer",
                    "products": "part", "sellers": "supplier"}


def _schema_diff() -> str:
    def row(source: str, t: str, view: str, valid: str = "true", missing: str = "[]", extra: str = "[]",
            mismatches: str = "[]") -> str:
        return (f"SELECT '{source}' AS source, '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
                f"{valid} AS schema_valid, CAST({missing} AS VARCHAR[]) AS missing_columns, "
                f"CAST({extra} AS VARCHAR[]) AS extra_columns, len({mismatches}) = 0 AS types_valid, "
                f"CAST({mismatches} AS VARCHAR[]) AS type_mismatches FROM {view}")

    parts = [row("canonical", t, CANON_VIEW[t]) for t in REGISTRY]
    for t, raw in RAW_COUNTERPARTS.items():
        exp = "[" + ", ".join(f"'{c}'" for c, _ in COLUMNS[t]) + "]"
        missing = f"list_sort(list_filter({exp}, lambda x: NOT list_contains(any_value(act), x)))"
        extra = f"list_sort(list_filter(any_value(act), lambda x: NOT list_contains({exp}, x)))"
        parts.append(row("raw", t, f"{raw}, (SELECT list(column_name) AS act FROM (DESCRIBE {raw}))",
                         f"len({missing}) = 0", missing, extra))
    seventh = "count(*) FILTER (WHERE order_id % 7 = 0)"
    parts.append(row("retyped", "orders", "c_orders",
                     mismatches=f"['customer_id: bigint, ' || {seventh} || ' values need string']"))
    parts.append(row("retyped", "order_items", "c_items", mismatches=(
        f"['order_item_id: int, ' || {seventh} || ' values need double', 'price: decimal(18,2), values need double']")))
    return "\nUNION ALL ".join(parts)


def _empty_fields() -> str:
    parts = []
    for t in REGISTRY:
        cells = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c, _ in COLUMNS[t])
        parts.append(f"SELECT '{t}' AS table_name, CAST(COALESCE(sum({cells}), 0) AS BIGINT) AS empty_fields "
                     f"FROM {CANON_VIEW[t]}")
    return "\nUNION ALL ".join(parts)


def _any_null(t: str) -> str:
    return " OR ".join(f"{c} IS NULL" for c, _ in COLUMNS[t])


def _inputs(kind: str) -> str:
    """The drop lacks geolocation, reviews is a file without a line, customers
    have two headers, the products' header has a name twice, and order items
    have one line with a field too many, which is a row without NULLs that the
    parser marks."""
    parts = []
    for t in ALL_INPUTS:
        view, one = CANON_VIEW.get(t), int(t == "order_items")
        rows = f"CAST(count(*) + {one} AS BIGINT)"
        if kind == "completeness":
            parts.append(f"SELECT '{t}' AS table_name, true AS present, count(*) > 0 AS complete, {rows} AS row_count FROM {view}"
                         if view else f"SELECT '{t}' AS table_name, {str(t == 'reviews').lower()} AS present, "
                                      "false AS complete, CAST(0 AS BIGINT) AS row_count")
            continue
        status = "loaded" if view else "empty" if t == "reviews" else "missing"
        groups = 2 if t == "customers" else 1 if view else 0
        twice = "product_weight_g" if t == "products" else ""
        said = (f"SELECT '{t}' AS table_name, '{status}' AS status, CAST({groups} AS BIGINT) AS header_groups, "
                f"'{twice}' AS duplicate_columns, ")
        if view:
            parts.append(f"{said}{rows} AS row_count, CAST({one} AS BIGINT) AS corrupt_rows, "
                         f"CAST(count(*) FILTER (WHERE {_any_null(t)}) AS BIGINT) AS rows_with_nulls FROM {view}")
        else:
            parts.append(f"{said}CAST(0 AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS corrupt_rows, "
                         "CAST(0 AS BIGINT) AS rows_with_nulls")
    return "\nUNION ALL ".join(parts)


def _csv_text(name: str, kind: str) -> str:
    """A value as Spark's CSV writer renders it (no value here needs quotes
    but the empty text)."""
    if kind == "timestamp_ntz":
        text = f"strftime({name}, '%Y-%m-%dT%H:%M:%S.%g')"
    elif kind == "string":
        text = f"CASE WHEN {name} = '' THEN '\"\"' ELSE {name} END"
    else:
        text = f"CAST({name} AS VARCHAR)"
    return f"COALESCE({text}, '')"


def _text_profile() -> str:
    """Sellers' lines end in two bytes; the products' lines have their weight
    and one again at the end; customers have two headers of the same names."""
    parts = []
    for t in ALL_INPUTS:
        if t not in REGISTRY:
            parts.append(f"SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS records, CAST(0 AS BIGINT) AS line_rows, "
                         "0 AS header_columns, '' AS header, CAST(0 AS BIGINT) AS header_groups, CAST(0 AS BIGINT) AS data_bytes")
            continue
        names = [n for n, _ in COLUMNS[t]] + ["product_weight_g"] * (t == "products")
        texts = [_csv_text(n, k) for n, k in COLUMNS[t]] + ["COALESCE(CAST(product_weight_g + 1 AS VARCHAR), '')"] * (
            t == "products")
        line = " + 1 + ".join(f"strlen({x})" for x in texts)   # separators, then the line's end
        parts.append(
            f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS records, CAST(count(*) AS BIGINT) AS line_rows, "
            f"{len(names)} AS header_columns, '{','.join(names)}' AS header, "
            f"CAST({2 if t == 'customers' else 1} AS BIGINT) AS header_groups, "
            f"CAST(sum({line} + {2 if t == 'sellers' else 1}) AS BIGINT) AS data_bytes FROM {CANON_VIEW[t]}")
    return "\nUNION ALL ".join(parts)


REPORT_CELLS = {   # report: key columns, then text and number columns
    "order_status": (["order_status"], ["order_status"], ["total_orders", "order_percentage"]),
    "monthly_revenue": (["year", "month_number"], ["month_name"],
                        ["year", "month_number", "total_orders", "monthly_revenue", "previous_month_revenue",
                         "revenue_change", "growth_percentage"]),
    "state_performance": (["customer_state"], ["customer_state", "performance_tier"],
                          ["total_orders", "total_customers", "total_revenue", "avg_order_value", "avg_delivery_days",
                           "revenue_rank", "revenue_quartile", "revenue_share_percentage"]),
    "running_revenue": (["order_date"], ["order_date"],
                        ["daily_orders", "daily_revenue", "cumulative_revenue", "cumulative_revenue_percentage",
                         "seven_day_avg_revenue"]),
    "delivery_analysis": (["customer_state"], ["customer_state"],
                          ["delivered_orders", "avg_delivery_days", "late_orders", "on_time_orders",
                           "late_delivery_percentage"]),
}


def _long(name: str, sql: str, keys: list[str], texts: list[str], numbers: list[str]) -> str:
    key = f"concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})"
    cells = [(c, f"CAST({c} AS VARCHAR)", "NULL") for c in texts] + [(c, "NULL", f"CAST({c} AS DOUBLE)") for c in numbers]
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS report_name, {key} AS row_key, '{c}' AS column_name, CAST({t} AS VARCHAR) AS text_value, "
        f"CAST({n} AS DOUBLE) AS number_value FROM ({sql})" for c, t, n in cells)


def _all_reports() -> str:
    return "\nUNION ALL ".join(_long(n, REPORT_COLS[n][0], *REPORT_CELLS[n]) for n in REPORT_CELLS)


def _sql_files() -> str:
    status = ("SELECT order_status, count(*) AS orders, sum(revenue) AS revenue FROM c_analytics GROUP BY order_status")
    late = ("SELECT customer_state, count(*) AS late_orders, max(delivery_days) AS slowest_days FROM c_delivery_vw "
            "WHERE is_late GROUP BY customer_state")
    return (_long("status_revenue", status, ["order_status"], ["order_status"], ["orders", "revenue"]) + "\nUNION ALL "
            + _long("late_by_state", late, ["customer_state"], ["customer_state"], ["late_orders", "slowest_days"]))


def _dq(dataset: str, view: str, keys: list[str], required: list[str], present: list[str]) -> str:
    held = [c for c in required if c in present]
    lost = len(required) - len(held)
    hollow = " + ".join(["0 * count(*)"] + [f"CAST(count(*) > 0 AND count({c}) = 0 AS BIGINT)" for c in held])
    parts = [
        f"SELECT '{dataset}' AS dataset, 'required_columns' AS rule, 'fail' AS severity, "
        f"CAST({lost} AS BIGINT) AS observed, {str(lost == 0).lower()} AS passed",
        f"SELECT '{dataset}', 'filled_columns', 'info', CAST({hollow} AS BIGINT), {hollow} = 0 FROM {view}",
        f"SELECT '{dataset}', 'non_empty', 'fail', CAST(count(*) AS BIGINT), count(*) > 0 FROM {view}"]
    if all(k in present for k in keys):
        null_cond = " OR ".join(f"{k} IS NULL" for k in keys)
        key_list = ", ".join(keys)
        parts += [
            f"SELECT '{dataset}', 'null_keys', 'fail', CAST(count(*) FILTER (WHERE {null_cond}) AS BIGINT), "
            f"count(*) FILTER (WHERE {null_cond}) = 0 FROM {view}",
            f"SELECT '{dataset}', 'duplicate_keys', 'info', CAST(count(*) AS BIGINT), true FROM "
            f"(SELECT {key_list} FROM {view} GROUP BY {key_list} HAVING count(*) > 1)"]
    return "\nUNION ALL ".join(parts)


def _dq_all() -> str:
    order = ["order_id", "order_status"]
    return "\nUNION ALL ".join([
        _dq("master_orders", "c_master", ["order_id"], order, order),
        _dq("order_items", "c_items", ["order_id", "order_item_id"], ["order_id", "order_item_id"],
            ["order_id", "order_item_id"]),
        _dq("raw_orders", "orders", ["order_id"], order, ["o_orderkey", "o_orderstatus"]),
        _dq("unapproved_orders", "(SELECT order_id, order_status, CASE WHEN order_id < 0 THEN order_approved_at END "
            "AS order_approved_at FROM c_orders)", ["order_id"], [*order, "order_approved_at"], [*order, "order_approved_at"]),
        _dq("lost_orders", "(SELECT * FROM c_orders WHERE order_status = 'lost')", ["order_id"], order, order)])


def _registry_counts(tables) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {CANON_VIEW[t]}"
        for t in tables)


REPORT_COLS = {"order_status": (ORDER_STATUS, 3), "monthly_revenue": (MONTHLY_REVENUE, 8),
               "state_performance": (STATE_PERFORMANCE, 10), "running_revenue": (RUNNING_REVENUE, 6),
               "delivery_analysis": (DELIVERY_ANALYSIS, 6)}


def _bodies() -> dict[str, str]:
    b = {
        "order_status_report": ORDER_STATUS,
        "monthly_revenue_report": MONTHLY_REVENUE,
        "state_performance_report": STATE_PERFORMANCE,
        "running_revenue_report": RUNNING_REVENUE,
        "delivery_analysis_report": DELIVERY_ANALYSIS,
        "orders_summary": """SELECT order_id, order_status, purchase_year, purchase_month, delivery_days,
            is_late, item_count, CAST(order_total AS DOUBLE) AS order_total,
            CAST(total_payment AS DOUBLE) AS total_payment, customer_state FROM c_master""",
        "typed_timestamps": """SELECT order_id, order_purchase_timestamp,
            CASE WHEN order_status = 'P' THEN NULL ELSE order_approved_at END AS order_approved_at,
            order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
            FROM c_orders""",
        "clean_orders": "SELECT * FROM c_clean_orders",
        "date_parts": "SELECT order_id, purchase_year, purchase_month, purchase_day_of_week FROM c_clean_orders",
        "date_diff_days": "SELECT order_id, delivery_days FROM c_clean_orders",
        "late_flag": "SELECT order_id, is_late FROM c_clean_orders",
        "dedup_orders": """SELECT order_id, customer_id, order_status, order_purchase_timestamp,
            order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
            order_estimated_delivery_date FROM c_clean_orders""",
        "dedup_order_lines": """SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
            CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value FROM c_items
            QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY
              product_id DESC NULLS LAST, seller_id DESC NULLS LAST, shipping_limit_date DESC NULLS LAST,
              price DESC NULLS LAST, freight_value DESC NULLS LAST) = 1""",
        "fill_nulls": FILLED_PRODUCTS,
        "enrich_products": ENRICHED,
        "positive_payments": """SELECT order_id, payment_sequential, payment_type, payment_installments,
            CAST(payment_value AS DOUBLE) AS payment_value FROM c_payments WHERE payment_value > 0""",
        "aggregate_payments": """SELECT order_id, CAST(total_payment AS DOUBLE) AS total_payment,
            CAST(payment_count AS BIGINT) AS payment_count, payment_types FROM c_payment_summary""",
        "payment_types_set": "SELECT order_id, payment_types FROM c_payment_summary",
        "aggregate_items": """SELECT order_id, CAST(item_count AS BIGINT) AS item_count,
            CAST(items_total AS DOUBLE) AS items_total, CAST(freight_total AS DOUBLE) AS freight_total,
            CAST(order_total AS DOUBLE) AS order_total FROM c_items_summary""",
        "orders_items_join": f"""SELECT {CLEAN_ORDER_COLS}, i.item_count, CAST(i.items_total AS DOUBLE) AS items_total,
            CAST(i.freight_total AS DOUBLE) AS freight_total, CAST(i.order_total AS DOUBLE) AS order_total
            FROM c_clean_orders o LEFT JOIN c_items_summary i ON o.order_id = i.order_id""",
        "orders_payments_join": f"""SELECT {CLEAN_ORDER_COLS}, CAST(p.total_payment AS DOUBLE) AS total_payment,
            p.payment_count, p.payment_types
            FROM c_clean_orders o LEFT JOIN c_payment_summary p ON o.order_id = p.order_id""",
        "orders_customer_join": f"""SELECT {CLEAN_ORDER_COLS}, c.customer_unique_id, c.customer_zip_code_prefix,
            c.customer_city, c.customer_state
            FROM c_clean_orders o LEFT JOIN c_customers c ON o.customer_id = c.customer_id""",
        "build_master": f"SELECT {MASTER_MONEY} FROM c_master",
        "analytics_orders": """SELECT order_id, customer_id, order_status, order_purchase_timestamp,
            customer_state, CAST(revenue AS DOUBLE) AS revenue, delivery_days, is_late FROM c_analytics""",
        "schema_resolve": """SELECT order_id, customer_id, order_status, order_purchase_timestamp,
            customer_state, CAST(order_total AS DOUBLE) AS revenue, delivery_days, is_late FROM c_master""",
        "derive_delivery_days": "SELECT order_id, delivery_days FROM c_master",
        "normalize_boolean": """SELECT order_id, flag_text,
            CASE WHEN lower(trim(flag_text)) IN ('true', '1', 'yes', 'y', 't') THEN true
                 WHEN lower(trim(flag_text)) IN ('false', '0', 'no', 'n', 'f') THEN false END AS flag
            FROM (SELECT o_orderkey AS order_id,
                    CASE WHEN o_orderpriority LIKE '1%' THEN 'TRUE'
                         WHEN o_orderpriority LIKE '2%' THEN ' yes '
                         WHEN o_orderpriority LIKE '3%' THEN '0'
                         WHEN o_orderpriority LIKE '4%' THEN
                              CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'n' END
                         ELSE 'maybe' END AS flag_text FROM orders)""",
        "safe_casts": """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
            CAST(NULL AS INTEGER) AS flag_as_int, l_linenumber AS line_as_int,
            CASE WHEN l_linestatus = 'F' THEN false END AS status_as_boolean, l_tax AS tax_as_double
            FROM lineitem""",
        "round_half_up": f"""SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
            CAST(ROUND({PRICE} * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS discount_amount,
            CAST(ROUND({PRICE} * CAST(l_tax AS DECIMAL(4,2)), 1) AS DOUBLE) AS tax_amount_1dp
            FROM lineitem""",
        "arithmetic_ops": f"""SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
            CAST({PRICE} * CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS gross_value,
            CAST({PRICE} + ROUND({PRICE} * CAST(l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS price_with_freight,
            {hu(cents(PRICE), "CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS INTEGER) * 100")}
              AS price_per_discount_point
            FROM lineitem""",
        "null_predicates": """SELECT
            CAST(count(*) FILTER (WHERE is_late = TRUE) AS BIGINT) AS late_true,
            CAST(count(*) FILTER (WHERE is_late = FALSE) AS BIGINT) AS late_false,
            CAST(count(*) FILTER (WHERE is_late IS NULL) AS BIGINT) AS late_null,
            CAST(count(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS BIGINT) AS undelivered,
            CAST(count(*) FILTER (WHERE order_delivered_customer_date IS NOT NULL) AS BIGINT) AS delivered,
            CAST(count(*) FILTER (WHERE item_count IS NULL OR payment_count IS NULL) AS BIGINT)
              AS missing_items_or_payments
            FROM c_master""",
        "monthly_orders": """SELECT CAST(year(order_month) AS INTEGER) AS year,
            CAST(month(order_month) AS INTEGER) AS month_number, CAST(total_orders AS BIGINT) AS total_orders,
            CAST(monthly_revenue AS DOUBLE) AS monthly_revenue FROM c_monthly""",
        "month_name": """SELECT CAST(year(order_month) AS INTEGER) AS year,
            CAST(month(order_month) AS INTEGER) AS month_number, monthname(order_month) AS month_name
            FROM c_monthly""",
        "daily_orders": """SELECT order_date, CAST(daily_orders AS BIGINT) AS daily_orders,
            CAST(daily_revenue AS DOUBLE) AS daily_revenue FROM c_daily""",
        "distinct_customers_by_state": """SELECT customer_state, CAST(total_customers AS BIGINT) AS total_customers
            FROM c_state""",
        "late_on_time_counts": LATE_COUNTS,
        "share_of_total": f"""SELECT order_id, CAST(revenue AS DOUBLE) AS revenue,
            {hu(f"{cents('revenue')} * 100", f"sum({cents('revenue')}) OVER ()", 6)} AS revenue_share_percentage
            FROM c_analytics""",
        "order_windows": f"""SELECT o_orderkey, CAST(price AS DOUBLE) AS price,
            CAST(sum(price) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total,
            CAST(lag(price) OVER w AS DOUBLE) AS previous_price,
            {hu(f"sum({cents('price')}) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)",
                "count(price) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) * 100")} AS seven_order_avg
            FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
            WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""",
        "lag_month": f"SELECT year, month_number, monthly_revenue, previous_month_revenue FROM ({MONTHLY_REVENUE})",
        "growth_pct": f"SELECT year, month_number, revenue_change, growth_percentage FROM ({MONTHLY_REVENUE})",
        "dense_rank_state": """SELECT customer_state, CAST(total_revenue AS DOUBLE) AS total_revenue,
            CAST(dense_rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank FROM c_state""",
        "ntile_state": """SELECT customer_state, CAST(total_revenue AS DOUBLE) AS total_revenue,
            CAST(ntile(4) OVER (ORDER BY total_revenue DESC, customer_state) AS INTEGER) AS revenue_quartile
            FROM c_state""",
        "performance_tier": f"SELECT customer_state, revenue_quartile, performance_tier FROM ({STATE_PERFORMANCE})",
        "running_sum": """SELECT order_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue,
            CAST(sum(daily_revenue) OVER (ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 AS DOUBLE) AS cumulative_revenue FROM c_daily""",
        "moving_avg_7": f"""SELECT order_date, CAST(daily_orders AS BIGINT) AS daily_orders,
            CAST(daily_revenue AS DOUBLE) AS daily_revenue, {hu("s7", "n7 * 100")} AS seven_day_avg_revenue
            FROM (SELECT *, sum({cents('daily_revenue')}) OVER w AS s7, count(daily_revenue) OVER w AS n7
                  FROM c_daily WINDOW w AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
        "moving_avg_7_calendar": f"""SELECT order_date, CAST(daily_orders AS BIGINT) AS daily_orders,
            CAST(daily_revenue AS DOUBLE) AS daily_revenue,
            {hu("s7", "n7 * 100")} AS seven_calendar_day_avg_revenue
            FROM (SELECT *, sum({cents('daily_revenue')}) OVER w AS s7, count(daily_revenue) OVER w AS n7
                  FROM c_daily WINDOW w AS (ORDER BY order_date
                    RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW))""",
        "delivery_analysis_view": "SELECT * FROM c_delivery_vw",
        "run_reports": _all_reports(),
        "report_csv_roundtrip": _all_reports(),
        "report_preview": f"SELECT * FROM ({RUNNING_REVENUE}) ORDER BY order_date LIMIT 20",
        "kpi_totals": f"""SELECT CAST(count(*) AS BIGINT) AS total_orders,
            CAST(sum(revenue) AS DOUBLE) AS total_revenue,
            {hu(f"sum({cents('revenue')})", "count(revenue) * 100")} AS avg_order_value FROM c_analytics""",
        "top_products": f"""SELECT product_id, CAST(units_sold AS BIGINT) AS units_sold,
            CAST(orders AS BIGINT) AS orders, CAST(revenue AS DOUBLE) AS revenue
            FROM ({PRODUCT_SALES}) ORDER BY revenue DESC, product_id LIMIT 10""",
        "category_performance": f"""SELECT e.product_category_name, e.product_category_name_english,
            CAST(sum(s.units_sold) AS BIGINT) AS items_sold, CAST(count(*) AS BIGINT) AS products,
            CAST(sum(s.revenue) AS DOUBLE) AS revenue
            FROM ({PRODUCT_SALES}) s LEFT JOIN ({ENRICHED}) e ON s.product_id = e.product_id
            GROUP BY e.product_category_name, e.product_category_name_english""",
        "customer_distribution": f"""SELECT customer_state, CAST(customers AS BIGINT) AS customers,
            {hu("customers * 100", "sum(customers) OVER ()")} AS customer_share_percentage
            FROM (SELECT customer_state, count(DISTINCT customer_unique_id) AS customers
                  FROM c_customers GROUP BY customer_state)""",
        "seller_performance": """SELECT s.seller_id, d.seller_state, CAST(s.items_sold AS BIGINT) AS items_sold,
            CAST(s.orders AS BIGINT) AS orders, CAST(s.revenue AS DOUBLE) AS revenue,
            CAST(s.freight AS DOUBLE) AS freight,
            CAST(dense_rank() OVER (ORDER BY s.revenue DESC) AS INTEGER) AS revenue_rank
            FROM (SELECT seller_id, count(*) AS items_sold, count(DISTINCT order_id) AS orders,
                         sum(price) AS revenue, sum(freight_value) AS freight FROM c_items GROUP BY seller_id) s
            LEFT JOIN c_sellers d ON s.seller_id = d.seller_id""",
        "payment_mix": f"""SELECT payment_type, CAST(payments AS BIGINT) AS payments, CAST(orders AS BIGINT) AS orders,
            CAST(total_value AS DOUBLE) AS total_value,
            {hu(f"{cents('total_value')} * 100", f"sum({cents('total_value')}) OVER ()")} AS value_share_percentage
            FROM (SELECT payment_type, count(*) AS payments, count(DISTINCT order_id) AS orders,
                         sum(payment_value) AS total_value FROM c_payments WHERE payment_value > 0
                  GROUP BY payment_type)""",
        "clean_column_names": """SELECT o_orderkey AS o_orderkey_raw, o_custkey AS o_custkey_raw,
            o_orderstatus AS o_orderstatus_raw, o_totalprice AS o_totalprice_raw,
            o_orderdate AS o_orderdate_raw, o_orderpriority AS o_orderpriority_raw FROM orders""",
        "item_master": f"""SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id,
            CAST(i.price AS DOUBLE) AS price, CAST(i.freight_value AS DOUBLE) AS freight_value,
            e.product_category_name, e.product_category_name_english, s.seller_state,
            m.order_status, m.order_purchase_timestamp, m.customer_state, m.is_late
            FROM c_items i LEFT JOIN c_master m ON i.order_id = m.order_id
            LEFT JOIN ({ENRICHED}) e ON i.product_id = e.product_id
            LEFT JOIN c_sellers s ON i.seller_id = s.seller_id""",
        "null_counts": f"SELECT table_name, column_name, null_count FROM ({_column_stats()})",
        "null_percentage": f"""SELECT table_name, column_name, {hu("null_count * 100", "row_count")} AS null_percentage
            FROM ({_column_stats()})""",
        "logical_bytes": f"""SELECT table_name, CAST(sum(logical_bytes) AS BIGINT) AS logical_bytes
            FROM ({_column_stats()}) GROUP BY table_name""",
        "table_shape": f"""SELECT table_name, CAST(max(row_count) AS BIGINT) AS row_count,
            CAST(count(*) AS BIGINT) AS column_count FROM ({_column_stats()}) GROUP BY table_name""",
        "duplicate_rows": "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST(({_dups(CANON_VIEW[t])}) AS BIGINT) AS duplicate_rows"
            for t in REGISTRY),
        "profile_table": f"WITH cs AS ({_column_stats()}) SELECT * FROM ({_profile_rows()}) WHERE table_name = 'orders'",
        "profile_all_tables": f"WITH cs AS ({_column_stats()}) {_profile_rows()}",
        "schema_diff": _schema_diff(),
        "dq_report": _dq_all(),
        "dq_required_columns": f"SELECT * FROM ({_dq_all()}) WHERE rule IN ('required_columns', 'filled_columns')",
        "dq_non_empty": f"SELECT * FROM ({_dq_all()}) WHERE rule = 'non_empty'",
        "null_key_count": "SELECT CAST(count(*) FILTER (WHERE order_id IS NULL) AS BIGINT) AS null_keys FROM c_master",
        "duplicate_keys": """SELECT order_id, order_item_id, CAST(count(*) AS BIGINT) AS count FROM c_items
            GROUP BY order_id, order_item_id HAVING count(*) > 1""",
        "output_contract": """SELECT d.dataset, CAST(count(*) AS BIGINT) AS expected_rows,
            CAST(count(*) AS BIGINT) AS written_rows, true AS schema_match, d.whole AS content_match,
            true AS success_marker, d.whole AS passed
            FROM c_master, (VALUES ('master_orders', true), ('changed_orders', false)) d(dataset, whole)
            GROUP BY d.dataset, d.whole""",
        "source_row_counts": _registry_counts(["orders", "order_items", "customers", "products", "payments"]),
        "scan_csv_roundtrip": "SELECT * FROM c_orders",
        "empty_fields": _empty_fields(),
        "master_parquet_roundtrip": f"SELECT {MASTER_MONEY} FROM c_master",
        "column_types": f"SELECT table_name, position, column_name, data_type, inferred_type FROM ({_column_stats()})",
        "text_profile": _text_profile(),
        "csv_header_binding": """SELECT seller_id, CAST(NULL AS INTEGER) AS seller_zip_code_prefix, seller_city, seller_state,
            'loaded' AS status, false AS schema_valid, 'seller_state,seller_note,seller_city,seller_id' AS header,
            'seller_zip_code_prefix' AS missing_columns, 'seller_note' AS extra_columns FROM c_sellers""",
        "orders_summary_csv": """SELECT order_id, order_status, purchase_year, purchase_month, delivery_days,
            is_late, item_count, CAST(order_total AS DOUBLE) AS order_total,
            CAST(total_payment AS DOUBLE) AS total_payment, customer_state FROM c_master""",
        "sql_file_reports": _sql_files(),
        "input_completeness": _inputs("completeness"),
        "tolerant_scan": _inputs("scan"),
        "profile_json": f"WITH cs AS ({_column_stats()}) {_profile_rows(maps=True)}",
    }
    return b


def oracle_queries() -> dict[str, str]:
    return {k: with_canon(v) for k, v in _bodies().items()}
