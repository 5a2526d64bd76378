"""Strict date and instant parsing, day arithmetic and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_INSTANT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}.[0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)\z"
)
_ZONED = r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def strict_date(text: Column) -> Column:
    """``YYYY-MM-DD`` that exists in the calendar, else NULL."""
    return F.when(text.rlike(_DAY), text.try_cast("date"))


def strict_instant(text: Column) -> Column:
    """ISO-8601 instant with an explicit offset, else NULL."""
    tidy = F.regexp_replace(text, r"^([0-9-]{10}).", "$1T")
    # Offsets may come as +HH or +HHMM; the cast wants +HH:MM.
    tidy = F.regexp_replace(tidy, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    tidy = F.regexp_replace(tidy, r"(T[^+-]*[+-][0-9]{2})$", "$1:00")
    tidy = F.regexp_replace(tidy, ",", ".")
    # Minutes and seconds may be missing.
    tidy = F.regexp_replace(tidy, r"T([0-9]{2})(Z|[+-])", "T$1:00$2")
    tidy = F.regexp_replace(tidy, r"T([0-9]{2}:[0-9]{2})(Z|[+-])", "T$1:00$2")
    return F.when(text.rlike(_INSTANT), tidy.try_cast("timestamp"))


def has_zone(text: Column) -> Column:
    return F.coalesce(text.rlike(_ZONED), F.lit(False))


def days_between(end: Column, start: Column) -> Column:
    """Integer day count ``end - start`` (subtracting dates would give an interval)."""
    return F.datediff(end, start)


def is_annual_gap(end: Column, start: Column) -> Column:
    """350 to 380 days inclusive: the length that counts as one year."""
    return days_between(end, start).between(350, 380)


def has_annual_shape(period_type: Column, start: Column, end: Column) -> Column:
    """Durations span a year; instants have an end and no start."""
    duration = (period_type == "duration") & start.isNotNull() & is_annual_gap(end, start)
    instant = (period_type == "instant") & start.isNull() & end.isNotNull()
    return F.coalesce(duration, F.lit(False)) | F.coalesce(instant, F.lit(False))


def in_day_range(day: Column, first: Column, last: Column) -> Column:
    """Half-open slicer: ``first <= day < last + 1 day``."""
    return (day >= first) & (day < F.date_add(last, 1))


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Attributes of the warehouse calendar."""
    weekday = F.extract(F.lit("DAYOFWEEK_ISO"), day)
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": weekday,
        "is_weekend": weekday.isin(6, 7),
    }


def calendar_labels(day: Column) -> dict[str, Column]:
    """Labels and sort keys of the report calendar."""
    return {
        "calendar_year": F.year(day),
        "year_month": F.date_format(day, "yyyy-MM"),
        "year_month_sort": F.year(day) * 100 + F.month(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMM"),
        "quarter_number": F.quarter(day),
        "year_quarter": F.concat(F.date_format(day, "yyyy"), F.lit("-Q"), F.quarter(day)),
        "year_quarter_sort": F.year(day) * 10 + F.quarter(day),
        "weekday_number": F.extract(F.lit("DAYOFWEEK_ISO"), day),
        "weekday_name": F.date_format(day, "EEE"),
    }
