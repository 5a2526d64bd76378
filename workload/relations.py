"""Queries over the modelled relations: staging, dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import versions
from tidemark.plans import dimensions, standins
from tidemark.plans.relations import MARTS
from tidemark.sources.publish import report_extract, row_counts
from workload.registry import digits, query

R = standins.relations


@query("stg_market_prices", """
SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
  CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume, run_id, source_row_number,
  strftime(ingested_on, '%Y-%m-%d') || ' 00:00:00' AS ingested_at
FROM x_stg_prices
""")
def stg_market_prices(spark, sf):
    return R(spark, sf).stg_market_prices.select(
        "symbol", "trading_date", "open", "high", "low", "close", "volume", "run_id", "source_row_number", "ingested_at"
    )


@query("incremental_staging", """
SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, CAST(close AS DOUBLE) AS close, volume, run_id, source_row_number
FROM x_stg_prices
""")
def incremental_staging(spark, sf):
    """Runs of even orders staged first, those of odd orders brought in as arrivals."""
    rows = versions.with_provenance(standins.market_daily_prices(spark, sf), standins.ingestion_runs(spark, sf))
    odd = F.substring("run_id", -2, 1).isin("1", "3", "5", "7", "9")
    before = versions.latest_version(rows.where(~odd), S.PRICE_GRAIN)
    return versions.with_arrivals(before, rows.where(odd), S.PRICE_GRAIN).select(
        "symbol", "trading_date", "close", "volume", "run_id", "source_row_number"
    )


@query("stg_financial_facts", """
SELECT cik, taxonomy, concept, unit, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  accession_number, CAST(fiscal_year AS BIGINT) AS fiscal_year, fiscal_period, form, CAST(filed_date AS VARCHAR) AS filed_date,
  frame, CAST(value AS DOUBLE) AS value, entity_name, run_id, source_row_number
FROM x_stg_facts
""")
def stg_financial_facts(spark, sf):
    return R(spark, sf).stg_financial_facts.select(
        *S.FACT_GRAIN, "value", "entity_name", "run_id", "source_row_number"
    )


@query("stg_macro_observations", """
SELECT series_id, CAST(observation_date AS VARCHAR) AS observation_date, CAST(realtime_start AS VARCHAR) AS realtime_start,
  '9999-12-31' AS realtime_end, CAST(value AS DOUBLE) AS value, run_id, source_row_number
FROM x_stg_obs
""")
def stg_macro_observations(spark, sf):
    return R(spark, sf).stg_macro_observations.select(*S.OBSERVATION_GRAIN, "value", "run_id", "source_row_number")


@query("provenance_join", """
SELECT run_id, source_row_number, symbol, strftime(ingested_on, '%Y-%m-%d') || ' 00:00:00' AS ingested_at,
  strftime(ingested_on, '%Y-%m-%d') || ' 01:00:00' AS loaded_at
FROM x_prices
""")
def provenance_join(spark, sf):
    joined = versions.with_provenance(standins.market_daily_prices(spark, sf), standins.ingestion_runs(spark, sf))
    return joined.select("run_id", "source_row_number", "symbol", "ingested_at", "loaded_at")


@query("restated_versions", """
SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, count(*) AS version_count,
  count(DISTINCT close) AS distinct_closes
FROM x_prices GROUP BY ALL HAVING count(*) > 1
""")
def restated_versions(spark, sf):
    """Rows kept in several versions; staging picks the latest of them."""
    rows = versions.with_provenance(standins.market_daily_prices(spark, sf), standins.ingestion_runs(spark, sf))
    counted = rows.groupBy(*S.PRICE_GRAIN).agg(
        F.count("*").alias("version_count"), F.count_distinct("close").alias("distinct_closes")
    )
    return counted.where("version_count > 1")


@query("dim_company", "SELECT cik, entity_name FROM x_company")
def dim_company(spark, sf):
    return R(spark, sf).dim_company


@query("dim_date", """
SELECT CAST(d AS VARCHAR) AS date_day, year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day_of_month,
  isodow(d) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
FROM (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(min(v) AS TIMESTAMP) AS lo, CAST(max(v) AS TIMESTAMP) AS hi FROM (
    SELECT trading_date AS v FROM x_stg_prices UNION ALL SELECT start_date FROM x_stg_facts
    UNION ALL SELECT end_date FROM x_stg_facts UNION ALL SELECT filed_date FROM x_stg_facts
    UNION ALL SELECT observation_date FROM x_stg_obs)))
""")
def dim_date(spark, sf):
    return R(spark, sf).dim_date


@query("dim_financial_metric", """
SELECT DISTINCT p_type AS metric_key, p_type || ' ' || p_brand AS metric_name,
  CASE WHEN p_size % 2 = 0 THEN 'instant' ELSE 'duration' END AS period_type
FROM part
""")
def dim_financial_metric(spark, sf):
    """Distinct metrics of a mapping; the parts play the mapped concepts."""
    part = standins.table(spark, sf, "part")
    mapping = part.select(
        F.col("p_name").alias("concept"),
        F.col("p_type").alias("metric_key"),
        F.concat_ws(" ", "p_type", "p_brand").alias("metric_name"),
        F.when(F.col("p_size") % 2 == 0, "instant").otherwise("duration").alias("period_type"),
    )
    return dimensions.dim_financial_metric(mapping)


@query("dim_macro_series", "SELECT DISTINCT series_id FROM x_stg_obs")
def dim_macro_series(spark, sf):
    return R(spark, sf).dim_macro_series


@query("fact_market_daily", """
SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
  CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume
FROM x_stg_prices
""")
def fact_market_daily(spark, sf):
    return R(spark, sf).fact_market_daily


@query("fact_financial_reported", """
SELECT cik, metric_key, taxonomy, concept, unit, CAST(value AS DOUBLE) AS value, CAST(start_date AS VARCHAR) AS start_date,
  CAST(end_date AS VARCHAR) AS end_date, accession_number, CAST(fiscal_year AS BIGINT) AS fiscal_year, fiscal_period, form,
  CAST(filed_date AS VARCHAR) AS filed_date, frame
FROM x_reported
""")
def fact_financial_reported(spark, sf):
    return R(spark, sf).fact_financial_reported


@query("fact_macro_observation", """
SELECT series_id, CAST(observation_date AS VARCHAR) AS observation_date, CAST(realtime_start AS VARCHAR) AS realtime_start,
  '9999-12-31' AS realtime_end, CAST(value AS DOUBLE) AS value
FROM x_macro
""")
def fact_macro_observation(spark, sf):
    return R(spark, sf).fact_macro_observation


@query("mart_company_daily_performance", """
SELECT company_key, current_ticker, current_cik, company_name, CAST(trading_date AS VARCHAR) AS trading_date,
  CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
  volume, CAST(previous_close AS DOUBLE) AS previous_close, CAST(daily_change AS DOUBLE) AS daily_change, daily_return
FROM x_performance
""")
def mart_company_daily_performance(spark, sf):
    return R(spark, sf).mart_company_daily_performance


@query("mart_company_financial_growth", """
SELECT company_key, current_ticker, source_cik, metric_key, metric_name, period_type, taxonomy, concept, unit,
  CAST(fiscal_year AS BIGINT) AS fiscal_year, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  CAST(CAST(current_value AS DECIMAL(38,10)) AS VARCHAR) AS current_value, CAST(previous_end_date AS VARCHAR) AS previous_end_date,
  CAST(CAST(previous_value AS DECIMAL(38,10)) AS VARCHAR) AS previous_value,
  CAST(CAST(absolute_change AS DECIMAL(38,10)) AS VARCHAR) AS absolute_change, growth_rate,
  form, CAST(filed_date AS VARCHAR) AS filed_date, accession_number
FROM x_growth
""")
def mart_company_financial_growth(spark, sf):
    mart = R(spark, sf).mart_company_financial_growth
    return mart.withColumns({c: digits(F.col(c)) for c in ("current_value", "previous_value", "absolute_change")})


@query("mart_market_macro", """
SELECT company_key, current_ticker, current_cik, company_name, CAST(trading_date AS VARCHAR) AS trading_date, series_id,
  CAST(market_close AS DOUBLE) AS market_close, market_volume, CAST(macro_observation_date AS VARCHAR) AS macro_observation_date,
  CAST(macro_value AS DOUBLE) AS macro_value, macro_age_days
FROM x_aligned
""")
def mart_market_macro(spark, sf):
    return R(spark, sf).mart_market_macro


@query("mart_row_counts", """
SELECT 'mart_company_daily_performance' AS "table", count(*) AS row_count FROM x_performance
UNION ALL SELECT 'mart_company_financial_growth', count(*) FROM x_growth
UNION ALL SELECT 'mart_market_macro', count(*) FROM x_aligned
""")
def mart_row_counts(spark, sf):
    relations = R(spark, sf)
    return row_counts({name: relations[name] for name in MARTS})


@query("report_extract_growth", """
SELECT company_key, metric_key, unit, CAST(end_date AS VARCHAR) AS end_date, CAST(current_value AS DOUBLE) AS current_value,
  CAST(previous_value AS DOUBLE) AS previous_value, growth_rate,
  CASE metric_name WHEN 'Equity Attributable to Parent' THEN 'Equity'
    WHEN 'Net Income (Loss) Attributable to Parent' THEN 'Net Income'
    WHEN 'Revenue from Contracts with Customers, Excluding Assessed Tax' THEN 'Revenue'
    ELSE metric_name END AS metric_short_name
FROM x_growth
""")
def report_extract_growth(spark, sf):
    extract = report_extract(R(spark, sf).mart_company_financial_growth)
    return extract.select(
        "company_key", "metric_key", "unit", "end_date", "current_value", "previous_value", "growth_rate", "metric_short_name"
    )
