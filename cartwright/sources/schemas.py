"""Canonical commerce tables: typed schemas and the expected-column registry."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, TS, B = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                     T.TimestampNTZType(), T.BooleanType())
M = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Typed schemas of the canonical tables as this library produces them; the
# column names are fixed values (the source data dictionary, including its own
# misspelling "lenght").  Keys are integral (the test tables use bigint keys); money is decimal(18,2).
SCHEMAS: dict[str, T.StructType] = {
    "orders": _struct(
        ("order_id", L), ("customer_id", L), ("order_status", S),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS),
    ),
    "order_items": _struct(
        ("order_id", L), ("order_item_id", I), ("product_id", L), ("seller_id", L),
        ("shipping_limit_date", TS), ("price", M), ("freight_value", M),
    ),
    "customers": _struct(
        ("customer_id", L), ("customer_unique_id", L), ("customer_zip_code_prefix", I),
        ("customer_city", S), ("customer_state", S),
    ),
    "products": _struct(
        ("product_id", L), ("product_category_name", S), ("product_name_lenght", I),
        ("product_description_lenght", I), ("product_photos_qty", I), ("product_weight_g", I),
        ("product_length_cm", I), ("product_height_cm", I), ("product_width_cm", I),
    ),
    "sellers": _struct(
        ("seller_id", L), ("seller_zip_code_prefix", I), ("seller_city", S), ("seller_state", S),
    ),
    "payments": _struct(
        ("order_id", L), ("payment_sequential", I), ("payment_type", S),
        ("payment_installments", I), ("payment_value", M),
    ),
    "category_translation": _struct(
        ("product_category_name", S), ("product_category_name_english", S),
    ),
}

# Master-table column order, as the master build emits it.
MASTER_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "purchase_year", "purchase_month",
    "purchase_day_of_week", "delivery_days", "is_late", "item_count", "items_total",
    "freight_total", "order_total", "customer_unique_id", "customer_zip_code_prefix",
    "customer_city", "customer_state", "total_payment", "payment_count", "payment_types",
]

# The orders-summary extract.
SUMMARY_COLUMNS = [
    "order_id", "order_status", "purchase_year", "purchase_month", "delivery_days",
    "is_late", "item_count", "order_total", "total_payment", "customer_state",
]


def _raw_type(name: str, canonical: T.DataType) -> T.DataType:
    """Raw CSV drops carry text identifiers and zip prefixes (leading zeros
    matter); money is read straight into exact decimals."""
    if (name.endswith("_id") and name != "order_item_id") or name.endswith("zip_code_prefix"):
        return S
    return canonical


RAW_SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType([T.StructField(f.name, _raw_type(f.name, f.dataType), True)
                         for f in schema.fields])
    for table, schema in SCHEMAS.items()
}
RAW_SCHEMAS["reviews"] = _struct(
    ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
    ("review_comment_message", S), ("review_creation_date", TS), ("review_answer_timestamp", TS),
)
RAW_SCHEMAS["geolocation"] = _struct(
    ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
    ("geolocation_city", S), ("geolocation_state", S),
)

# The expected column names per source table, in the order of the profile.
EXPECTED_COLUMNS: dict[str, list[str]] = {
    table: RAW_SCHEMAS[table].names for table in (
        "orders", "order_items", "customers", "products", "sellers", "payments", "reviews", "geolocation",
        "category_translation")
}

# The five tables the transform reads row counts of, and the full input set.
COUNTED_SOURCES = ("orders", "order_items", "customers", "products", "payments")
REQUIRED_INPUTS = tuple(EXPECTED_COLUMNS)

# File name of each source table in a raw CSV drop (override per call).
RAW_FILES: dict[str, str] = {name: f"{name}.csv" for name in EXPECTED_COLUMNS}
