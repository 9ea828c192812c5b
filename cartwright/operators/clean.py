"""Cleaning operators: typing, derived fields, deterministic dedup, fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.scalars import late_flag, safe_timestamp

# The order timestamp columns typed by the cleaner.
ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

# Per-column replacements for missing product attributes.
PRODUCT_FILLS = {
    "product_category_name": "unknown",
    "product_weight_g": 0,
    "product_length_cm": 0,
    "product_height_cm": 0,
    "product_width_cm": 0,
    "product_photos_qty": 0,
}


def typed_timestamps(df: DataFrame, columns: Sequence[str] = ORDER_TIMESTAMPS,
                     fmt: str | None = None) -> DataFrame:
    """Replace each listed column by its timestamp; bad text -> NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    todo = [c for c in columns if c in types and not isinstance(types[c], T.TimestampNTZType)]
    if not todo:
        return df          # already typed: no projection to plan
    return df.withColumns({c: safe_timestamp(c, types[c], fmt) for c in todo})


def derive_order_fields(df: DataFrame) -> DataFrame:
    """Purchase year / month / day of week (1 = Sunday), calendar days to
    delivery, and the late flag (undelivered counts as not late)."""
    purchase = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    return df.withColumns({
        "purchase_year": F.year(purchase),
        "purchase_month": F.month(purchase),
        "purchase_day_of_week": F.dayofweek(purchase),
        "delivery_days": F.datediff(delivered, purchase),
        "is_late": late_flag(delivered, "order_estimated_delivery_date"),
    })


def dedup_by_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the row whose ``prefer`` columns, then remaining
    columns in schema order, are greatest (NULL ranks lowest).

    Deterministic, so a recomputed partition after executor loss yields the
    same survivor.  Implemented as an aggregate (``max`` of a row struct), so
    Spark combines map-side first: a key holding a third of all rows is
    collapsed before the shuffle instead of landing whole in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ranked = list(prefer) + [c for c in rest if c not in prefer]

    def q(name: str) -> str:
        return f"`{name}`"

    best = F.max(F.struct(*[q(c) for c in ranked])).alias("_best")
    out = df.groupBy(*[q(k) for k in keys]).agg(best)
    return out.select(*[q(k) for k in keys], "_best.*").select(*[q(c) for c in df.columns])


def clean_orders(orders: DataFrame) -> DataFrame:
    """Typed timestamps, derived fields, one row per ``order_id``."""
    return dedup_by_key(derive_order_fields(typed_timestamps(orders)), ["order_id"])


def fill_nulls(df: DataFrame, values: dict | None = None) -> DataFrame:
    """``fillna`` restricted to the columns the frame actually has."""
    values = PRODUCT_FILLS if values is None else values
    return df.fillna({k: v for k, v in values.items() if k in df.columns})


def positive_payments(payments: DataFrame, column: str = "payment_value") -> DataFrame:
    """Keep strictly positive payments (drops zero, negative and NULL)."""
    return payments.where(F.col(column) > 0)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Lower-case snake_case column names (trim, non-alphanumerics -> '_').
    Names that become equal get ``_2``, ``_3`` ... in column order, skipping
    suffixed names that another column has already."""
    import re

    def norm(name: str) -> str:
        s = re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_").lower()
        return s or "col"

    plain = [norm(c) for c in df.columns]
    taken, out = set(), []
    for name in plain:
        free, k = name, 1
        while free in taken or (k > 1 and free in plain):
            k += 1
            free = f"{name}_{k}"
        taken.add(free)
        out.append(free)
    return df.toDF(*out)
