from cartwright.functions.columns import (
    CANDIDATES,
    delivery_days_expr,
    UnresolvedFields,
    is_late_expr,
    resolve_fields,
)
from cartwright.functions.scalars import (
    MONEY,
    cents,
    half_up_ratio,
    late_flag,
    money,
    month_name,
    normalize_boolean,
    safe_cast,
    safe_timestamp,
    tier_label,
)

__all__ = [
    "CANDIDATES", "MONEY", "UnresolvedFields", "cents", "delivery_days_expr", "half_up_ratio",
    "is_late_expr", "late_flag", "money", "month_name", "normalize_boolean", "resolve_fields",
    "safe_cast", "safe_timestamp", "tier_label",
]
