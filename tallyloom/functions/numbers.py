"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """`part` as a percentage of `whole`, halves rounded away from zero, in integer arithmetic.

    Two bigint counts give the same digits on every engine: no binary fraction is rounded.
    Counts may reach 4e14 at two digits before the intermediate overflows.
    """
    scale = 10**digits
    part, whole = part.cast("bigint"), F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    size = F.abs(whole)
    # `div` cuts off towards zero, so the magnitude is rounded and the sign put back
    units = F.call_function("div", F.abs(part) * F.lit(200 * scale).cast("bigint") + size, size * F.lit(2))
    return F.when((part < 0) != (whole < 0), -units).otherwise(units) / F.lit(scale)


def percent_text(part: Column, whole: Column, digits: int = 2) -> Column:
    """The same percentage as grouped text, such as `1,234.50`."""
    return F.format_number(percent(part, whole, digits), digits)


def percent_decimal(part: Column, whole: Column, digits: int = 2) -> Column:
    """The same percentage as `decimal(10, digits)`."""
    return percent(part, whole, digits).cast(f"decimal(10,{digits})")


def null_if_not_positive(value: Column) -> Column:
    """Zero and negative measures carry no information: make them null."""
    return F.when(value <= 0, F.lit(None)).otherwise(value)


def floor_at_zero(value: Column) -> Column:
    """Negative counts become 0, nulls stay null."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def safe_ratio(top: Column, bottom: Column, digits: int) -> Column:
    """`top / bottom` rounded, null where the divisor is zero or null."""
    return F.round(F.try_divide(top.cast("double"), bottom.cast("double")), digits)


def parse_integer(text: Column, kind: str = "bigint") -> Column:
    """A whole number out of text, null for anything else.

    Text that is no number is told apart before the cast, which would raise and catch an
    exception for each such row.
    """
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast(kind))
