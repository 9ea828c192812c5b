"""Scalar column builders.

All of these return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Text spellings accepted by the boolean normaliser, checked
# after trim + lower-case, and the tier label per revenue quartile.
TRUE_TOKENS = ("true", "1", "yes", "y")
FALSE_TOKENS = ("false", "0", "no", "n")
TIER_LABELS = ("Top Performing", "High Performing", "Medium Performing", "Low Performing")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Money as an exact two-decimal value (rounded from doubles)."""
    return col_of(c).cast(MONEY)


def cents(c: str | Column) -> Column:
    """Integral number of cents of a two-decimal money value."""
    return (col_of(c) * 100).cast(T.DecimalType(38, 0))


# The text forms Spark's cast accepts as booleans (after trim
# and lower-case).
CAST_TRUE = ("t", "true", "y", "yes", "1")
CAST_FALSE = ("f", "false", "n", "no", "0")
NUMERIC_WORDS = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


# Fixed value: what Spark's casts from text strip at both ends (white space
# and control characters of ASCII).
CAST_SPACE = "".join(map(chr, range(33))) + "\x7f"


def trim_all(c: Column) -> Column:
    return F.btrim(c, F.lit(CAST_SPACE))


def safe_cast(c: str | Column, to: T.DataType | str, from_type: T.DataType | None = None) -> Column:
    """``try_cast`` with the same result, minus its slow path.

    Under ANSI mode a failing ``try_cast`` from text costs an exception per
    row (measured ~30x a valid cast).  Text that cannot possibly parse is
    sent to NULL by a cheap guard first: numbers need a digit (or a
    NaN/Infinity word), booleans must be one of Spark's accepted spellings.
    Non-text inputs go straight to ``try_cast``.
    """
    c = col_of(c)
    target = T.DataType.fromDDL(to) if isinstance(to, str) else to
    if from_type is not None and not isinstance(from_type, T.StringType):
        return c.try_cast(target)
    text = c.cast("string")
    if isinstance(target, T.BooleanType):
        norm = F.lower(trim_all(text))
        return F.when(norm.isin(*CAST_TRUE), F.lit(True)).when(norm.isin(*CAST_FALSE), F.lit(False))
    if isinstance(target, T.NumericType):
        plausible = text.rlike("[0-9]") | F.lower(trim_all(text)).isin(*NUMERIC_WORDS)
        return F.when(plausible, text.try_cast(target))
    return text.try_cast(target)


def safe_timestamp(c: str | Column, dtype: T.DataType, fmt: str | None = None) -> Column:
    """Timestamp without time zone; unparseable text becomes NULL.

    ``dtype`` is the input column's type, known at plan time, so already
    typed columns pass through without a cast.  Text is cast straight to
    ``timestamp_ntz`` (the same forms ``to_timestamp`` accepts without a
    format), so no session time zone is involved: a wall-clock time that
    falls in a daylight-saving gap stays as written.  Under ANSI mode plain
    casts raise on bad text, hence the guarded ``try_cast``.  With an
    explicit ``fmt`` the text is parsed by ``try_to_timestamp`` in the
    session time zone (keep sessions on UTC for that path).
    """
    c = col_of(c)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast(T.TimestampNTZType())
    text = c.cast("string")
    if fmt:
        return F.try_to_timestamp(text, F.lit(fmt)).cast(T.TimestampNTZType())
    return F.when(text.rlike("[0-9]"), text.try_cast(T.TimestampNTZType()))


def half_up_ratio(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``round(num / den, scale)`` with HALF_UP on the exact quotient.

    ``num`` and ``den`` must be integral (counts, cents, day sums).  The
    quotient is formed with exact decimal remainder arithmetic, so the result
    does not depend on an intermediate decimal scale.  NULL when ``den`` is 0 or NULL (the
    non-ANSI result of ``x / 0``).  Returns double.  Pass materialised
    columns: window or aggregate expressions given here are repeated.
    """
    n = col_of(num).cast(T.DecimalType(38, 0))
    d = col_of(den).cast(T.DecimalType(38, 0))
    a = F.abs(n) * F.lit(2 * 10**scale) + F.abs(d)
    b = F.abs(d) * F.lit(2)
    # (a - a % b) is a multiple of b, so the decimal division is exact;
    # integral ``div`` would return a long and silently wrap on overflow.
    q = ((a - a % b) / b).cast(T.DecimalType(38, 0))
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return F.when(d != 0, (signed / F.lit(10**scale)).cast("double"))


def late_flag(delivered: str | Column, estimated: str | Column) -> Column:
    """True only when delivered after the estimate; NULL comparison -> False."""
    return F.when(col_of(delivered) > col_of(estimated), F.lit(True)).otherwise(F.lit(False))


def normalize_boolean(c: str | Column, dtype: T.DataType) -> Column:
    """Boolean from heterogeneous text: true/1/yes/y, false/0/no/n, else a
    lenient cast (NULL when it fails).  Boolean input passes through."""
    c = col_of(c)
    if isinstance(dtype, T.BooleanType):
        return c
    text = F.lower(trim_all(c.cast("string")))
    return (
        F.when(text.isin(*TRUE_TOKENS), F.lit(True))
        .when(text.isin(*FALSE_TOKENS), F.lit(False))
        .otherwise(safe_cast(c, T.BooleanType(), dtype))
    )


def tier_label(quartile: str | Column) -> Column:
    q = col_of(quartile)
    return (
        F.when(q == 1, F.lit(TIER_LABELS[0]))
        .when(q == 2, F.lit(TIER_LABELS[1]))
        .when(q == 3, F.lit(TIER_LABELS[2]))
        .otherwise(F.lit(TIER_LABELS[3]))
    )


def month_name(c: str | Column) -> Column:
    """Full English month name (``monthname`` gives the 3-letter form).
    Looked up from the month number, so no time zone is involved."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(col_of(c)))
