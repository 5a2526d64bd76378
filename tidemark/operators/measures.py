"""Measure layer: scalar measures of a filter context, evaluated per group.

A request names a mart, slicer filters, grouping columns and measures; it runs as one
filter and one grouped aggregation.  A measure is NULL unless its gate holds:

* market measures need exactly one company in the group;
* growth measures need exactly one company, metric and unit in the slicer selection;
* market/macro measures need exactly one company and series in the slicer selection.

"Exactly one" is decided with min and max, which combine before the shuffle, instead
of distinct counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import divide
from tidemark.functions.temporal import calendar_labels, in_day_range
from tidemark.operators.timeseries import calendar_spine, column_bounds, merged_bounds

#: Name of the gate column while a growth or macro request is evaluated.
_VALID = "_context_valid"


# --- building blocks ------------------------------------------------------------

def selected_value(value: str) -> Column:
    """The value if the group holds exactly one distinct value, NULL counting as one."""
    one = (F.count(value) == F.count(F.lit(1))) & (F.min(value) == F.max(value))
    return F.when(one, F.max(value))


def has_one(value: str) -> Column:
    """Exactly one distinct value, NULL counting as one."""
    column = F.col(value)
    all_null = F.count(value) == 0
    none_null = F.count(value) == F.count(F.lit(1))
    return (F.count(F.lit(1)) > 0) & (all_null | (none_null & (F.min(column) == F.max(column))))


def at_latest(value: str, day: str) -> Column:
    """The value on the last day of the group (NULL if it is NULL on that day)."""
    return F.max_by(value, day)


def at_earliest(value: str, day: str) -> Column:
    return F.min_by(value, day)


def distinct_days(day: str) -> Column:
    return F.count_distinct(day)


def _gated(gate: Column, measure: Column) -> Column:
    return F.when(gate, measure)


@dataclass(frozen=True)
class DayRange:
    """Slicer over a date column, both days included."""

    first: date
    last: date


Filter = Sequence[object] | DayRange


# --- market ---------------------------------------------------------------------

def _market() -> dict[str, Column]:
    day, close = "trading_date", "close"
    start, end = at_earliest(close, day), at_latest(close, day)
    period_return = F.when(
        (F.min(day) != F.max(day)) & (start != 0), divide(end, start) - 1.0
    )
    measures = {
        "close": selected_value(close),
        "daily_return": selected_value("daily_return"),
        "daily_volume": selected_value("volume"),
        "latest_trading_date": F.max(day),
        "latest_close": end,
        "previous_trading_close": at_latest("previous_close", day),
        "daily_change": at_latest("daily_change", day),
        "daily_change_percent": at_latest("daily_return", day),
        "period_start_close": start,
        "period_end_close": end,
        "selected_period_return": period_return,
        "average_daily_return": F.avg("daily_return"),
        "minimum_close": F.min(close),
        "maximum_close": F.max(close),
        "average_close": F.avg(close),
        "total_volume": F.sum("volume"),
        "average_daily_volume": F.avg("volume"),
        "trading_days": distinct_days(day),
    }
    return {name: _gated(has_one("company_key"), measure) for name, measure in measures.items()}


# --- growth ---------------------------------------------------------------------

def _growth(gate: Column) -> dict[str, Column]:
    day, value = "end_date", "current_value"
    prior = F.when(at_latest("absolute_change", day).isNotNull(), at_latest("previous_value", day))
    measures = {
        "financial_value": selected_value(value),
        "growth_rate": selected_value("growth_rate"),
        "latest_reporting_period": F.max(day),
        "prior_comparable_value": prior,
        "latest_financial_value": at_latest(value, day),
        "latest_growth_rate": at_latest("growth_rate", day),
        "latest_filed_date": at_latest("filed_date", day),
        "financial_periods": distinct_days(day),
        "minimum_financial_value": F.min(value),
        "maximum_financial_value": F.max(value),
        "average_financial_value": F.avg(value),
    }
    gated = {name: _gated(gate, measure) for name, measure in measures.items()}
    return {"financial_context_is_valid": F.coalesce(gate, F.lit(False)).cast("int"), **gated}


# --- market / macro -------------------------------------------------------------

def _macro(gate: Column) -> dict[str, Column]:
    day = "trading_date"
    measures = {
        "market_close": selected_value("market_close"),
        "macro_value": selected_value("macro_value"),
        "macro_observation_date": selected_value("macro_observation_date"),
        "macro_observation_age": selected_value("macro_age_days"),
        "market_macro_latest_trading_date": F.max(day),
        "latest_market_close": at_latest("market_close", day),
        "latest_aligned_macro_value": at_latest("macro_value", day),
        "latest_macro_observation_date": at_latest("macro_observation_date", day),
        "latest_macro_observation_age": at_latest("macro_age_days", day),
        "market_macro_trading_days": distinct_days(day),
        # A distinct count in the report counts blank as one value.
        "distinct_macro_observation_dates": F.count_distinct("macro_observation_date")
        + F.max(F.col("macro_observation_date").isNull().cast("int")),
    }
    gated = {name: _gated(gate, measure) for name, measure in measures.items()}
    return {"market_macro_context_is_valid": F.coalesce(gate, F.lit(False)).cast("int"), **gated}


@dataclass(frozen=True)
class MeasureGroup:
    """Measures over one mart; ``selected`` are the columns its gate looks at."""

    measures: Mapping[str, Column] = field(default_factory=dict)
    selected: tuple[str, ...] = ()


#: Columns the selection gate of a mart looks at.
GATE_COLUMNS = {
    "market": (),
    "growth": ("company_key", "metric_key", "unit"),
    "macro": ("company_key", "series_id"),
}


def _all(conditions: Sequence[Column]) -> Column:
    combined = conditions[0]
    for more in conditions[1:]:
        combined = combined & more
    return combined


def measure_group(mart: str, *, whole_selection: bool = False) -> MeasureGroup:
    """Measures of a mart.  With ``whole_selection`` the group is the whole selection, so
    its gate is part of the same aggregation; otherwise it is read from a column."""
    selected = GATE_COLUMNS[mart]
    if mart == "market":
        return MeasureGroup(_market())
    gate = _all([has_one(c) for c in selected]) if whole_selection else F.bool_and(_VALID)
    return MeasureGroup(_growth(gate) if mart == "growth" else _macro(gate), selected)


# --- requests -------------------------------------------------------------------

def apply_filters(df: DataFrame, filters: Mapping[str, Filter]) -> DataFrame:
    """Slicers: a list keeps its members, a ``DayRange`` its days."""
    for column, wanted in filters.items():
        if isinstance(wanted, DayRange):
            df = df.where(in_day_range(F.col(column), F.lit(wanted.first), F.lit(wanted.last)))
        else:
            df = df.where(F.col(column).isin(list(wanted)))
    return df


def _selection_gate(
    selection: DataFrame, selected: Sequence[str], filters: Mapping[str, Filter], companies: DataFrame | None
) -> Column:
    """Whether the slicer selection holds one value of every gate column, as a scalar."""
    own = [c for c in selected if c != "company_key" or companies is None]
    gate = selection.agg(_all([has_one(c) for c in own])).scalar()
    if companies is None:
        return gate
    picked = apply_filters(companies, {k: v for k, v in filters.items() if k == "company_key"})
    return gate & picked.agg(has_one("company_key")).scalar()


def measure_query(
    mart: DataFrame,
    kind: str,
    measures: Sequence[str],
    *,
    filters: Mapping[str, Filter] | None = None,
    group_by: Sequence[str] = (),
    companies: DataFrame | None = None,
) -> DataFrame:
    """Evaluate measures of one mart under slicers, per group.

    The gates of growth and macro measures look at the slicer selection, not at the
    group.  Companies are counted on the company dimension when it is given: a slicer
    on another column does not narrow the selected companies.
    """
    filters = filters or {}
    one_pass = not group_by and companies is None
    group = measure_group(kind, whole_selection=one_pass)
    rows = apply_filters(mart, filters)
    if group.selected and not one_pass:
        rows = rows.withColumn(_VALID, _selection_gate(rows, group.selected, filters, companies))
    return rows.groupBy(*group_by).agg(*[group.measures[m].alias(m) for m in measures])


def measure_by_day(mart: DataFrame, kind: str, measure: str, day: str, **request) -> DataFrame:
    """One measure per date, in date order, for a line chart."""
    return measure_query(mart, kind, [measure], group_by=[day], **request).orderBy(day)


def company_ranking(mart: DataFrame, filters: Mapping[str, Filter] | None = None) -> DataFrame:
    """Companies by period return, best first.  The company slicer does not apply here."""
    kept = {k: v for k, v in (filters or {}).items() if k not in ("company_key", "company_name", "current_ticker")}
    ranked = measure_query(
        mart, "market", ["selected_period_return"], filters=kept, group_by=["company_key", "company_name"]
    )
    return ranked.select("*", (F.col("selected_period_return") < 0).alias("is_negative")).orderBy(
        F.col("selected_period_return").desc_nulls_last(), "company_key"
    )


def observation_reuse(mart: DataFrame, **request) -> DataFrame:
    """Trading days that share each macro observation date."""
    return measure_query(
        mart, "macro", ["market_macro_trading_days"], group_by=["macro_observation_date"], **request
    )


def detail_table(
    mart: DataFrame, attributes: Sequence[str], sums: Sequence[str], filters: Mapping[str, Filter] | None = None
) -> DataFrame:
    """Attributes with summed numbers."""
    rows = apply_filters(mart, filters or {})
    return rows.groupBy(*attributes).agg(*[F.sum(c).alias(c) for c in sums])


# --- report dimensions ----------------------------------------------------------

def report_companies(performance: DataFrame, growth: DataFrame, macro: DataFrame) -> DataFrame:
    """Company keys of all three marts with their single-valued attributes.

    Each mart is reduced to its keys before the union; the attributes come from the
    performance mart and are NULL when it holds none or several for a company.
    """
    attributes = performance.groupBy("company_key").agg(
        *[selected_value(c).alias(c) for c in ("current_ticker", "current_cik", "company_name")]
    )
    keys = attributes.select("company_key")
    for mart in (growth, macro):
        keys = keys.unionByName(mart.select("company_key").distinct())
    return keys.distinct().join(attributes, "company_key", "left")


def report_calendar(performance: DataFrame, growth: DataFrame, macro: DataFrame) -> DataFrame:
    """Contiguous calendar over the seven date columns of the marts, with labels."""
    bounds = merged_bounds(
        column_bounds(performance, "trading_date"),
        column_bounds(growth, "start_date", "end_date", "previous_end_date", "filed_date"),
        column_bounds(macro, "trading_date", "macro_observation_date"),
    )
    labels = calendar_labels(F.col("date"))
    return calendar_spine(bounds, "date").select("date", *[c.alias(n) for n, c in labels.items()])


def calendar_summary(days: DataFrame, day: str = "date") -> DataFrame:
    """Row count, first, last and distinct days of a calendar."""
    return days.agg(
        F.count("*").alias("row_count"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.count_distinct(day).alias("distinct_days"),
    )


# The date column each mart meets the calendar with; the first is active.
DATE_ROLES = {
    "performance": ("trading_date",),
    "growth": ("end_date", "filed_date"),
    "macro": ("trading_date", "macro_observation_date"),
}


def star(mart: DataFrame, kind: str, companies: DataFrame, days: DataFrame, date_role: str | None = None) -> DataFrame:
    """The mart joined with the report dimensions.  ``date_role`` picks another date column."""
    roles = DATE_ROLES[kind]
    role = date_role or roles[0]
    if role not in roles:
        raise ValueError(f"{kind} has no relationship from {role} to the calendar")
    attributes = companies.select("company_key", *[F.col(c).alias(f"dim_{c}") for c in companies.columns if c != "company_key"])
    calendar = days.withColumnRenamed("date", role)
    return mart.join(attributes, "company_key", "left").join(calendar, role, "left")
