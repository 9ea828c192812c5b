"""A widening lattice of column types.

A column still has its declared type if every value fits it: a type widens to
another if all of its values are values of the other.  For columns that came
as text it is the values' text that has to fit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal digits that hold every value of a whole-number type.
WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
WHOLE_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
TIMES = (T.TimestampType, T.TimestampNTZType)


def widens_to(own: T.DataType, other: T.DataType) -> bool:
    """Whether every value of a type is a value of the other: whole numbers
    to wider ones, to decimals with room for their digits and on to floating
    point; decimals to those with no fewer digits on either side of the point;
    dates to timestamps; anything to text; nothing (void) to anything."""
    if isinstance(own, T.NullType) or isinstance(other, T.StringType) or own == other:
        return True
    whole, point = type(own) in WHOLE_DIGITS, isinstance(own, T.DecimalType)
    if type(other) in WHOLE_DIGITS:
        return whole and WHOLE_ORDER.index(type(own)) <= WHOLE_ORDER.index(type(other))
    if isinstance(other, T.DecimalType):
        digits, scale = (WHOLE_DIGITS[type(own)], 0) if whole else (own.precision - own.scale, own.scale) if point else (99, 0)
        return digits <= other.precision - other.scale and scale <= other.scale
    if isinstance(other, T.DoubleType):
        return whole or point or isinstance(own, T.FloatType)
    if isinstance(other, T.FloatType):
        return type(own) in (T.ByteType, T.ShortType)
    return isinstance(own, T.DateType) and isinstance(other, TIMES)


def text_fits(text: Column, declared: T.DataType) -> Column:
    """Whether a value's text (not NULL) is one of the declared type."""
    text = F.trim(text)
    if type(declared) in WHOLE_DIGITS:
        whole = text.rlike(r"^[+-]?[0-9]{1,19}$")
        # only what looks like one is cast: a failing cast of text is slow
        return F.coalesce(F.when(whole, text).try_cast(declared).isNotNull(), F.lit(False))
    if isinstance(declared, T.DecimalType):
        before, after = declared.precision - declared.scale, declared.scale
        return text.rlike(rf"^[+-]?0*[0-9]{{0,{before}}}(\.[0-9]{{0,{after}}}0*)?$") & text.rlike("[0-9]")
    if isinstance(declared, (T.DoubleType, T.FloatType)):
        return text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    if isinstance(declared, (T.DateType, *TIMES)):
        clock = r"([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?"
        form = text.rlike(rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{clock}$")
        return F.coalesce(F.when(form, text).try_cast(T.TimestampNTZType()).isNotNull(), F.lit(False))
    if isinstance(declared, T.BooleanType):
        return text.rlike("^(?i)(true|false)$")
    return F.lit(True)
