"""Ordered operators over daily series: lag, as-of alignment, calendar spine.

All of them work at day granularity on frames that are unique per (key, day), so a
window partition never holds more rows than there are days in the data, however many
input rows the key had.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import calendar_attributes
from tidemark.operators.relational import measured


def with_previous(
    df: DataFrame, keys: Sequence[str], order: str, previous: Mapping[str, str]
) -> DataFrame:
    """Add, per key, columns of the preceding row.  ``previous`` maps new name -> column.

    ``df`` must be unique per ``keys + [order]``; one window serves all columns.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(order).asc())
    return df.select(
        "*", *[F.lag(column).over(window).alias(name) for name, column in previous.items()]
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    take: Mapping[str, str],
) -> DataFrame:
    """Backward, inclusive, left outer as-of join.

    Each left row gets the columns ``take`` (new name -> right column) of the right row
    with the same ``by`` and the greatest ``right_on <= left_on``, also when the values
    of that row are NULL.  ``right`` must be unique per ``by + [right_on]``.

    Only the distinct (by, day) probes enter the ordered window, together with the
    right rows; the answer is joined back on equality.  No pair of a probe and a
    non-matching right row is ever built.
    """
    by = list(by)
    keys = [F.col(c) for c in by]
    found = F.struct(*[F.col(column).alias(name) for name, column in take.items()])
    marks = right.select(*keys, F.col(right_on).alias("_day"), F.lit(0).alias("_side"), found.alias("_found"))
    empty = F.lit(None).cast(marks.schema["_found"].dataType)
    probes = (
        left.select(*keys, F.col(left_on).alias("_day"))
        .distinct()
        .select("*", F.lit(1).alias("_side"), empty.alias("_found"))
    )
    # On the same day the right row sorts first, so the match is inclusive.  The struct
    # itself is never NULL on the right side, so a NULL value inside it is not skipped.
    window = (
        Window.partitionBy(*by)
        .orderBy("_day", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        marks.unionByName(probes)
        .withColumn("_found", F.last("_found", ignorenulls=True).over(window))
        .where(F.col("_side") == 1)
        .select(*by, F.col("_day").alias(left_on), "_found")
    )
    joined = left.join(measured(answers, *by, left_on), [*by, left_on], "left")
    return joined.select("*", *[F.col(f"_found.{name}").alias(name) for name in take]).drop("_found")


def day_bounds(days: DataFrame, day: str) -> DataFrame:
    """One row with the first and last day; NULLs ignored."""
    return days.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def filled_forward(
    series: DataFrame,
    bounds: DataFrame,
    *,
    by: Sequence[str],
    on: str,
    day: str,
    take: Mapping[str, str],
) -> DataFrame:
    """One row per (series, calendar day) with the value in force on that day.

    Every row of ``series`` holds from its own day to the day before the next one;
    days before the first row carry NULLs.  ``bounds`` is the one-row frame of
    ``day_bounds``.  Rows are produced by exploding each validity span, so the result
    has exactly days x series rows and no join is needed to build it.
    """
    by = list(by)
    first = bounds.select("first_day").scalar()
    last = bounds.select("last_day").scalar()
    window = Window.partitionBy(*by).orderBy(on)
    found = F.struct(*[F.col(column).alias(name) for name, column in take.items()])

    ordered = series.select(
        *by,
        F.col(on).alias("_from"),
        F.lead(on).over(window).alias("_next"),
        F.lag(on).over(window).isNull().alias("_opens"),
        found.alias("_found"),
    ).select("*", first.alias("_first"), last.alias("_last"))
    nothing = F.lit(None).cast(ordered.schema["_found"].dataType)

    def span(start: Column, end: Column, value: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), value.alias("found"))

    own = span(
        F.greatest("_from", "_first"),
        F.least(F.coalesce(F.date_sub("_next", 1), F.col("_last")), F.col("_last")),
        F.col("_found"),
    )
    before = span(F.col("_first"), F.least(F.date_sub("_from", 1), F.col("_last")), nothing)
    spans = (
        ordered.select(*by, F.explode(F.array(own, F.when(F.col("_opens"), before))).alias("_span"))
        .where(F.col("_span.start") <= F.col("_span.end"))
        .select(*by, "_span.*")
    )
    return spans.select(
        *by, F.explode(F.sequence("start", "end")).alias(day), "found"
    ).select(*by, day, *[F.col(f"found.{name}").alias(name) for name in take])


def calendar_spine(bounds: DataFrame, day: str = "date_day") -> DataFrame:
    """Every day between the bounds, both included; no rows when the bounds are NULL."""
    step = F.expr("INTERVAL 1 DAY")
    return bounds.where(F.col("first_day").isNotNull()).select(
        F.explode(F.sequence("first_day", "last_day", step)).alias(day)
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """The gap-free calendar with its attributes."""
    attributes = calendar_attributes(F.col("date_day"))
    return calendar_spine(bounds).select(
        "date_day", *[column.alias(name) for name, column in attributes.items()]
    )


def merged_bounds(*bounds: DataFrame) -> DataFrame:
    """Overall bounds of several one-row bounds; the tables are never unioned row by row."""
    merged = bounds[0]
    for more in bounds[1:]:
        merged = merged.unionByName(more)
    return merged.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def column_bounds(df: DataFrame, *columns: str) -> DataFrame:
    """First and last day over several date columns of one table, in one scan."""
    low = [F.min(c) for c in columns]
    high = [F.max(c) for c in columns]
    pick = (F.least(*low), F.greatest(*high)) if len(columns) > 1 else (low[0], high[0])
    return df.agg(pick[0].alias("first_day"), pick[1].alias("last_day"))
