"""Marts: daily performance, annual growth and market/macro alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import exact_difference, growth_rate, simple_return
from tidemark.functions.temporal import days_between, has_annual_shape, is_annual_gap
from tidemark.operators.relational import measured
from tidemark.operators.timeseries import column_bounds, filled_forward, with_previous
from tidemark.operators.versions import newest_per_group
from tidemark.schemas import GROWTH_GRAIN

# Forms and period that make a fact annual.
ANNUAL_FORMS = ["10-K", "10-K/A"]
ANNUAL_PERIOD = "FY"

#: Latest filing first.  The columns after the accession number only settle ties within
#: one filing, so that the choice does not depend on how the data is partitioned.
REPRESENTATIVE_ORDER = [
    "filed_date",
    "accession_number",
    "fiscal_year",
    "start_date",
    "form",
    "taxonomy",
    "concept",
    "current_value",
]


#: What the market/macro mart takes of the daily performance.
MARKET_COLUMNS = ("company_key", "current_ticker", "current_cik", "company_name", "trading_date", "close", "volume")


def mart_company_daily_performance(
    fact_market: DataFrame, identities: DataFrame, companies: DataFrame
) -> DataFrame:
    """Prices of current registrants with previous close, change and return.

    The lag runs over the company, across registrants if the crosswalk should list several
    current ones.  The names of a company's registrants come as one map per company, so the
    join shares the window's shuffle.
    """
    current = identities.where("is_current_registrant").select(
        "company_key", "current_ticker", F.col("source_cik").alias("current_cik")
    )
    names = companies.select(F.col("cik").alias("current_cik"), F.col("entity_name").alias("company_name"))
    by_company = (
        current.join(names, "current_cik", "inner")
        .groupBy("company_key")
        .agg(F.map_from_entries(F.collect_set(F.struct("current_cik", "company_name"))).alias("_names"))
    )
    observed = fact_market.join(current, fact_market["symbol"] == current["current_ticker"], "inner").drop("symbol")
    lagged = (
        with_previous(observed, ["company_key"], "trading_date", {"previous_close": "close"})
        .join(by_company, "company_key", "inner")
        .where(F.map_contains_key("_names", F.col("current_cik")))
        .withColumn("company_name", F.element_at("_names", F.col("current_cik")))
    )
    return lagged.select(
        "company_key",
        "current_ticker",
        "current_cik",
        "company_name",
        "trading_date",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "previous_close",
        exact_difference(F.col("close"), F.col("previous_close"), 18).alias("daily_change"),
        simple_return(F.col("close"), F.col("previous_close")).alias("daily_return"),
    )


def annual_candidates(facts: DataFrame, identities: DataFrame, metrics: DataFrame) -> DataFrame:
    """Facts that may represent a company's year.  All filters run before any shuffle."""
    annual = facts.where(F.col("form").isin(ANNUAL_FORMS) & (F.col("fiscal_period") == ANNUAL_PERIOD))
    companies = identities.select("company_key", "current_ticker", "source_cik")
    return (
        annual.join(metrics, "metric_key", "inner")
        .where(has_annual_shape(F.col("period_type"), F.col("start_date"), F.col("end_date")))
        .withColumnRenamed("cik", "source_cik")
        .withColumnRenamed("value", "current_value")
        .join(companies, "source_cik", "inner")
    )


def mart_company_financial_growth(
    facts: DataFrame, identities: DataFrame, metrics: DataFrame
) -> DataFrame:
    """Representative annual facts compared with the preceding year.

    Predecessor and successor registrants share a company key, so a series continues
    across a change of registrant.
    """
    candidates = annual_candidates(facts, identities, metrics)
    representative = newest_per_group(candidates, GROWTH_GRAIN, REPRESENTATIVE_ORDER)
    lagged = with_previous(
        representative,
        ["company_key", "metric_key", "unit"],
        "end_date",
        {"previous_end_date": "end_date", "previous_value": "current_value"},
    )
    comparable = is_annual_gap(F.col("end_date"), F.col("previous_end_date"))
    current, previous = F.col("current_value"), F.col("previous_value")
    return lagged.select(
        "company_key",
        "current_ticker",
        "source_cik",
        "metric_key",
        "metric_name",
        "period_type",
        "taxonomy",
        "concept",
        "unit",
        "fiscal_year",
        "start_date",
        "end_date",
        "current_value",
        "previous_end_date",
        "previous_value",
        F.when(comparable, exact_difference(current, previous, 10)).alias("absolute_change"),
        F.when(comparable, growth_rate(current, previous, 10)).alias("growth_rate"),
        "form",
        "filed_date",
        "accession_number",
    )


def mart_market_macro(performance: DataFrame, fact_macro: DataFrame, prices: DataFrame) -> DataFrame:
    """Every company day against every series, with the latest observation on that day.

    The alignment depends on the day only, so it is worked out once per (series, day)
    and met with the companies by an equi-join on the trading date.  Each series has a
    row for every day between the first and last price, hence the join alone yields
    the complete company x day x series grid without a cartesian product.
    """
    aligned = filled_forward(
        fact_macro,
        column_bounds(prices, "trading_date"),
        by=["series_id"],
        on="observation_date",
        day="trading_date",
        take={"macro_observation_date": "observation_date", "macro_value": "value"},
    )
    market = performance.select(
        *MARKET_COLUMNS[:-2],
        F.col("close").alias("market_close"),
        F.col("volume").alias("market_volume"),
    )
    # Aligned days are never NULL, so this equals a join on equality.  That would ask for a day
    # of every price, and the mart could not share the shuffles of the performance it is read with.
    days = measured(aligned.withColumnRenamed("trading_date", "_day"), "_day")
    return market.join(days, F.col("trading_date").eqNullSafe(F.col("_day")), "inner").select(
        "company_key",
        "current_ticker",
        "current_cik",
        "company_name",
        "trading_date",
        "series_id",
        "market_close",
        "market_volume",
        "macro_observation_date",
        "macro_value",
        days_between(F.col("trading_date"), F.col("macro_observation_date")).alias("macro_age_days"),
    )
