"""Dimensions and facts over the staging relations.

Except for the two pure projections, these functions also accept all versions of the
source rows instead of the latest ones (see ``Relations._versions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.timeseries import calendar, column_bounds, merged_bounds
from tidemark.operators.versions import latest_version
from tidemark.schemas import RECENCY


def dim_company(facts: DataFrame) -> DataFrame:
    """The most recently filed name of every registrant."""
    return latest_version(facts, ["cik"], ["filed_date", *RECENCY]).select("cik", "entity_name")


def dim_date(prices: DataFrame, facts: DataFrame, observations: DataFrame) -> DataFrame:
    """Gap-free calendar over every date the staging relations mention.

    Each relation is reduced to its own first and last day before they are combined,
    so three rows are unioned instead of five date columns.
    """
    bounds = merged_bounds(
        column_bounds(prices, "trading_date"),
        column_bounds(facts, "start_date", "end_date", "filed_date"),
        column_bounds(observations, "observation_date"),
    )
    return calendar(bounds)


def dim_financial_metric(mapping: DataFrame) -> DataFrame:
    return mapping.select("metric_key", "metric_name", "period_type").distinct()


def dim_macro_series(observations: DataFrame) -> DataFrame:
    return observations.select("series_id").distinct()


def fact_market_daily(prices: DataFrame) -> DataFrame:
    return prices.select("symbol", "trading_date", "open", "high", "low", "close", "volume")


def fact_financial_reported(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Facts of mapped concepts.  Unmapped concepts stay in staging only."""
    keys = mapping.select("taxonomy", "concept", "metric_key")
    return facts.join(keys, ["taxonomy", "concept"], "inner").select(
        "cik",
        "metric_key",
        "taxonomy",
        "concept",
        "unit",
        "value",
        "start_date",
        "end_date",
        "accession_number",
        "fiscal_year",
        "fiscal_period",
        "form",
        "filed_date",
        "frame",
    )


def fact_macro_observation(observations: DataFrame) -> DataFrame:
    """The current vintage of every observation."""
    newest = ["realtime_start", "realtime_end", *RECENCY]
    return latest_version(observations, ["series_id", "observation_date"], newest).select(
        "series_id", "observation_date", "realtime_start", "realtime_end", "value"
    )
