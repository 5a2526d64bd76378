"""Exact decimals, counts, flags and change metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

_DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INTEGER = r"^[+-]?[0-9]+$"

#: Text the macro provider uses for a missing observation.
MISSING_MARKER = "."


def is_decimal_literal(text: Column) -> Column:
    """A finite decimal literal; NaN, infinities and free text are not."""
    return F.coalesce(strip(text).rlike(_DECIMAL), F.lit(False))


def fraction_digits(text: Column) -> Column:
    """Digits a decimal literal needs after the point, trailing zeros not counted."""
    literal = strip(text)
    fraction = F.rtrim(F.regexp_extract(literal, r"\.([0-9]*)", 1), F.lit("0"))
    whole = F.regexp_extract(literal, r"^[+-]?([0-9]*)", 1)
    exponent = F.coalesce(
        F.nullif(F.regexp_extract(literal, r"[eE]([+-]?[0-9]+)$", 1), F.lit("")).try_cast("int"),
        F.lit(0),
    )
    zeros = F.length(whole) - F.length(F.rtrim(whole, F.lit("0")))
    is_zero = ~literal.rlike(r"^[+-]?[0-9.]*[1-9]")
    needed = F.when(fraction != "", F.length(fraction) - exponent).otherwise(-exponent - zeros)
    return F.when(is_zero, F.lit(0)).otherwise(F.greatest(needed, F.lit(0)))


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """The literal as a decimal; NULL when it is not one or does not fit."""
    return F.when(
        is_decimal_literal(text), strip(text).try_cast(f"decimal({precision},{scale})")
    )


def fits_exactly(text: Column, precision: int, scale: int) -> Column:
    """Whether a literal survives the cast digit for digit."""
    # Nearly all literals are plain and short enough; only the others are taken apart.
    plain = rf"^-?[0-9]{{1,{precision - scale}}}(\.[0-9]{{1,{scale}}})?$"
    careful = to_decimal(text, precision, scale).isNotNull() & (fraction_digits(text) <= scale)
    return F.when(text.rlike(plain), True).otherwise(careful)


def non_negative_count(text: Column) -> Column:
    """A non-negative whole number from its text, else NULL."""
    number = F.when(strip(text).rlike(_INTEGER), strip(text).try_cast("bigint"))
    return F.when(number >= 0, number)


def is_missing(text: Column) -> Column:
    return F.coalesce(text == MISSING_MARKER, F.lit(False))


def exact_difference(current: Column, previous: Column, scale: int) -> Column:
    """``current - previous`` without the digit Spark gives up on full-width operands.

    One digit of head-room on each side makes the result type DECIMAL(38, scale).
    """
    narrow = f"decimal(37,{scale})"
    return current.cast(narrow) - previous.cast(narrow)


def simple_return(current: Column, previous: Column) -> Column:
    """``current / previous - 1``; NULL without a previous value or when it is zero."""
    base = previous.cast("double")
    return F.when(base != 0, current.cast("double") / base - 1.0)


def growth_rate(current: Column, previous: Column, scale: int) -> Column:
    """Change relative to the magnitude of the previous value; NULL on zero or NULL."""
    change = exact_difference(current, previous, scale).cast("double")
    return F.when(previous != 0, change / F.abs(previous.cast("double")))


def percent_delta(current: Column, previous: Column) -> Column:
    """Percentage movement; NULL without a previous value or when it is zero."""
    base = previous.cast("double")
    return F.when(base != 0, (current.cast("double") - base) / base * 100.0)


def divide(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
