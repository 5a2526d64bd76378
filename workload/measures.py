"""Measure layer queries: measures under slicers, report pages and report dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import measures as M
from tidemark.plans import standins
from tidemark.plans.relations import MARKET
from workload.registry import query

R = standins.relations

PERIOD = M.DayRange(date(1996, 1, 1), date(1998, 12, 31))
_IN_PERIOD = "trading_date >= DATE '1996-01-01' AND trading_date < DATE '1999-01-01'"


def _rounded(df, *columns):
    """Averages depend on the order of addition; compare them at ten digits."""
    return df.select(*[F.round(F.col(c).cast("double"), 8).alias(c) if c in columns else F.col(c) for c in df.columns])


@query("market_measures", f"""
SELECT company_key, CAST(max(trading_date) AS VARCHAR) AS latest_trading_date,
  CAST(arg_max_null(close, trading_date) AS DOUBLE) AS latest_close,
  CAST(arg_max_null(previous_close, trading_date) AS DOUBLE) AS previous_trading_close,
  CAST(arg_max_null(daily_change, trading_date) AS DOUBLE) AS daily_change,
  arg_max_null(daily_return, trading_date) AS daily_change_percent,
  CAST(arg_min_null(close, trading_date) AS DOUBLE) AS period_start_close,
  CAST(arg_max_null(close, trading_date) AS DOUBLE) AS period_end_close,
  CASE WHEN count(DISTINCT trading_date) >= 2 AND arg_min_null(close, trading_date) <> 0
    THEN CAST(arg_max_null(close, trading_date) AS DOUBLE) / CAST(arg_min_null(close, trading_date) AS DOUBLE) - 1 END AS selected_period_return,
  round(avg(daily_return), 8) AS average_daily_return, CAST(min(close) AS DOUBLE) AS minimum_close, CAST(max(close) AS DOUBLE) AS maximum_close,
  round(CAST(sum(close) AS DOUBLE) / count(*), 8) AS average_close, CAST(sum(volume) AS BIGINT) AS total_volume,
  round(avg(volume), 8) AS average_daily_volume, count(DISTINCT trading_date) AS trading_days
FROM x_performance WHERE {_IN_PERIOD} GROUP BY company_key
""")
def market_measures(spark, sf):
    names = [n for n in M.measure_group("market").measures if n not in ("close", "daily_return", "daily_volume")]
    result = M.measure_query(
        R(spark, sf).mart_company_daily_performance, "market", names,
        filters={"trading_date": PERIOD}, group_by=["company_key"],
    )
    return _rounded(result, "average_daily_return", "average_close", "average_daily_volume")


@query("market_measures_per_day", f"""
SELECT company_key, CAST(trading_date AS VARCHAR) AS trading_date, CAST(max(close) AS DOUBLE) AS close,
  max(daily_return) AS daily_return, max(volume) AS daily_volume
FROM x_performance WHERE {_IN_PERIOD} GROUP BY 1, 2
""")
def market_measures_per_day(spark, sf):
    return M.measure_query(
        R(spark, sf).mart_company_daily_performance, "market", ["close", "daily_return", "daily_volume"],
        filters={"trading_date": PERIOD}, group_by=["company_key", "trading_date"],
    )


@query("market_measures_need_one_company", """
SELECT CAST(year(trading_date) AS BIGINT) AS year,
  CASE WHEN count(DISTINCT company_key) = 1 THEN count(DISTINCT trading_date) END AS trading_days,
  CASE WHEN count(DISTINCT company_key) = 1 THEN CAST(max(close) AS DOUBLE) END AS maximum_close
FROM x_performance WHERE company_key = 'C0000001' OR year(trading_date) = 2000 GROUP BY 1
""")
def market_measures_need_one_company(spark, sf):
    mart = R(spark, sf).mart_company_daily_performance.withColumn("year", F.year("trading_date"))
    rows = mart.where((F.col("company_key") == "C0000001") | (F.col("year") == 2000))
    return M.measure_query(rows, "market", ["trading_days", "maximum_close"], group_by=["year"])


@query("close_per_day", """
SELECT CAST(trading_date AS VARCHAR) AS trading_date, CASE WHEN count(*) = 1 THEN CAST(max(close) AS DOUBLE) END AS close
FROM x_performance GROUP BY 1
""")
def close_per_day(spark, sf):
    return M.measure_by_day(R(spark, sf).mart_company_daily_performance, "market", "close", "trading_date")


@query("company_ranking", f"""
SELECT company_key, company_name, r AS selected_period_return, r < 0 AS is_negative FROM (
  SELECT company_key, company_name, CASE WHEN count(DISTINCT trading_date) >= 2 THEN
    CAST(arg_max_null(close, trading_date) AS DOUBLE) / CAST(arg_min_null(close, trading_date) AS DOUBLE) - 1 END AS r
  FROM x_performance WHERE {_IN_PERIOD} GROUP BY 1, 2)
""")
def company_ranking(spark, sf):
    """The company slicer is ignored by the ranking, the date slicer is not."""
    return M.company_ranking(
        R(spark, sf).mart_company_daily_performance, {"company_key": ["C0000001"], "trading_date": PERIOD}
    )


_GROWTH = "WITH g AS (SELECT * FROM x_growth WHERE company_key = 'C0000001' AND metric_key = 'total_assets' AND unit = 'USD')"
_GROWTH_FILTERS = {"company_key": ["C0000001"], "metric_key": ["total_assets"], "unit": ["USD"]}


@query("growth_measures", _GROWTH + """
SELECT 1 AS financial_context_is_valid, CAST(max(end_date) AS VARCHAR) AS latest_reporting_period,
  CASE WHEN arg_max_null(absolute_change, end_date) IS NOT NULL THEN CAST(arg_max_null(previous_value, end_date) AS DOUBLE) END AS prior_comparable_value,
  CAST(arg_max_null(current_value, end_date) AS DOUBLE) AS latest_financial_value, arg_max_null(growth_rate, end_date) AS latest_growth_rate,
  CAST(arg_max_null(filed_date, end_date) AS VARCHAR) AS latest_filed_date, count(DISTINCT end_date) AS financial_periods,
  CAST(min(current_value) AS DOUBLE) AS minimum_financial_value, CAST(max(current_value) AS DOUBLE) AS maximum_financial_value,
  round(CAST(sum(current_value) AS DOUBLE) / count(*), 8) AS average_financial_value
FROM g
""")
def growth_measures(spark, sf):
    names = [n for n in M.measure_group("growth").measures if n not in ("financial_value", "growth_rate")]
    result = M.measure_query(R(spark, sf).mart_company_financial_growth, "growth", names, filters=_GROWTH_FILTERS)
    return _rounded(result, "average_financial_value")


@query("growth_measures_per_period", _GROWTH + """
SELECT CAST(end_date AS VARCHAR) AS end_date, CAST(current_value AS DOUBLE) AS financial_value, growth_rate FROM g
""")
def growth_measures_per_period(spark, sf):
    return M.measure_query(
        R(spark, sf).mart_company_financial_growth, "growth", ["financial_value", "growth_rate"],
        filters=_GROWTH_FILTERS, group_by=["end_date"],
    )


@query("growth_measures_without_context", """
SELECT company_key, 0 AS financial_context_is_valid, CAST(NULL AS DOUBLE) AS latest_financial_value FROM x_growth GROUP BY 1
""")
def growth_measures_without_context(spark, sf):
    """Several companies, metrics and units are selected, so every measure is blank."""
    return M.measure_query(
        R(spark, sf).mart_company_financial_growth, "growth",
        ["financial_context_is_valid", "latest_financial_value"], group_by=["company_key"],
    )


@query("latest_against_prior", _GROWTH + """
SELECT CAST(arg_max_null(current_value, end_date) AS DOUBLE) AS latest_financial_value,
  CASE WHEN arg_max_null(absolute_change, end_date) IS NOT NULL THEN CAST(arg_max_null(previous_value, end_date) AS DOUBLE) END AS prior_comparable_value
FROM g
""")
def latest_against_prior(spark, sf):
    return M.measure_query(
        R(spark, sf).mart_company_financial_growth, "growth",
        ["latest_financial_value", "prior_comparable_value"], filters=_GROWTH_FILTERS,
    )


_MACRO = "WITH m AS (SELECT * FROM x_aligned WHERE company_key = 'C0000002' AND series_id = 'SIGNUP')"
_MACRO_FILTERS = {"company_key": ["C0000002"], "series_id": ["SIGNUP"]}


@query("macro_measures", _MACRO + """
SELECT 1 AS market_macro_context_is_valid, CAST(max(trading_date) AS VARCHAR) AS market_macro_latest_trading_date,
  CAST(arg_max_null(market_close, trading_date) AS DOUBLE) AS latest_market_close,
  CAST(arg_max_null(macro_value, trading_date) AS DOUBLE) AS latest_aligned_macro_value,
  CAST(arg_max_null(macro_observation_date, trading_date) AS VARCHAR) AS latest_macro_observation_date,
  arg_max_null(macro_age_days, trading_date) AS latest_macro_observation_age,
  count(DISTINCT trading_date) AS market_macro_trading_days,
  count(DISTINCT macro_observation_date) + max(CASE WHEN macro_observation_date IS NULL THEN 1 ELSE 0 END) AS distinct_macro_observation_dates
FROM m
""")
def macro_measures(spark, sf):
    per_day = ("market_close", "macro_value", "macro_observation_date", "macro_observation_age")
    names = [n for n in M.measure_group("macro").measures if n not in per_day]
    return M.measure_query(R(spark, sf).mart_market_macro, "macro", names, filters=_MACRO_FILTERS)


@query("macro_measures_per_day", _MACRO + """
SELECT CAST(trading_date AS VARCHAR) AS trading_date, CAST(market_close AS DOUBLE) AS market_close, CAST(macro_value AS DOUBLE) AS macro_value,
  CAST(macro_observation_date AS VARCHAR) AS macro_observation_date, macro_age_days AS macro_observation_age FROM m
""")
def macro_measures_per_day(spark, sf):
    relations = R(spark, sf, (MARKET,))
    return M.measure_query(
        relations.mart_market_macro, "macro",
        ["market_close", "macro_value", "macro_observation_date", "macro_observation_age"],
        filters=_MACRO_FILTERS, group_by=["trading_date"],
        companies=relations.market.select("company_key").distinct(),
    )


@query("observation_reuse", _MACRO + """
SELECT CAST(macro_observation_date AS VARCHAR) AS macro_observation_date, count(DISTINCT trading_date) AS market_macro_trading_days
FROM m GROUP BY 1
""")
def observation_reuse(spark, sf):
    return M.observation_reuse(R(spark, sf).mart_market_macro, filters=_MACRO_FILTERS)


@query("detail_prices", """
SELECT company_name, CAST(year(trading_date) AS BIGINT) AS year, CAST(sum(close) AS DOUBLE) AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM x_performance GROUP BY 1, 2
""")
def detail_prices(spark, sf):
    mart = R(spark, sf).mart_company_daily_performance.withColumn("year", F.year("trading_date"))
    return M.detail_table(mart, ["company_name", "year"], ["close", "volume"])


@query("detail_facts", """
SELECT company_key, metric_name, unit, form, CAST(sum(current_value) AS DOUBLE) AS current_value, CAST(sum(absolute_change) AS DOUBLE) AS absolute_change
FROM x_growth GROUP BY 1, 2, 3, 4
""")
def detail_facts(spark, sf):
    return M.detail_table(
        R(spark, sf).mart_company_financial_growth, ["company_key", "metric_name", "unit", "form"], ["current_value", "absolute_change"]
    )


@query("detail_market_macro", f"""
SELECT company_key, series_id, CAST(sum(macro_value) AS DOUBLE) AS macro_value, CAST(sum(macro_age_days) AS BIGINT) AS macro_age_days
FROM x_aligned WHERE {_IN_PERIOD} GROUP BY 1, 2
""")
def detail_market_macro(spark, sf):
    return M.detail_table(
        R(spark, sf).mart_market_macro, ["company_key", "series_id"], ["macro_value", "macro_age_days"], {"trading_date": PERIOD}
    )


def _report(spark, sf):
    """The three marts, each computed once; the macro mart is a join on the day with the first."""
    relations = R(spark, sf, ("mart_company_daily_performance", "mart_company_financial_growth"))
    return (
        relations.mart_company_daily_performance,
        relations.mart_company_financial_growth,
        relations.mart_market_macro,
    )


@query("report_companies", """
SELECT k.company_key, p.current_ticker, p.current_cik, p.company_name
FROM (SELECT company_key FROM x_performance UNION SELECT company_key FROM x_growth UNION SELECT company_key FROM x_aligned) k
LEFT JOIN (SELECT DISTINCT company_key, current_ticker, current_cik, company_name FROM x_performance) p USING (company_key)
""")
def report_companies(spark, sf):
    return M.report_companies(*_report(spark, sf))


_REPORT_DAYS = """
WITH b AS (SELECT CAST(min(v) AS TIMESTAMP) AS lo, CAST(max(v) AS TIMESTAMP) AS hi FROM (
  SELECT trading_date AS v FROM x_performance UNION ALL SELECT start_date FROM x_growth UNION ALL SELECT end_date FROM x_growth
  UNION ALL SELECT previous_end_date FROM x_growth UNION ALL SELECT filed_date FROM x_growth
  UNION ALL SELECT macro_observation_date FROM x_aligned)),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
"""


@query("report_calendar", _REPORT_DAYS + """
SELECT CAST(d AS VARCHAR) AS date, year(d) AS calendar_year, strftime(d, '%Y-%m') AS year_month, year(d) * 100 + month(d) AS year_month_sort,
  month(d) AS month_number, strftime(d, '%b') AS month_name, quarter(d) AS quarter_number,
  strftime(d, '%Y') || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter, year(d) * 10 + quarter(d) AS year_quarter_sort,
  isodow(d) AS weekday_number, strftime(d, '%a') AS weekday_name FROM d
""")
def report_calendar(spark, sf):
    return M.report_calendar(*_report(spark, sf))


@query("calendar_summary", _REPORT_DAYS + """
SELECT count(*) AS row_count, CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day, count(DISTINCT d) AS distinct_days FROM d
""")
def calendar_summary(spark, sf):
    return M.calendar_summary(M.report_calendar(*_report(spark, sf)))


@query("star_by_filed_date", """
SELECT g.company_key, p.company_name AS dim_company_name, year(g.filed_date) AS calendar_year, quarter(g.filed_date) AS quarter_number,
  count(*) AS fact_count, CAST(sum(g.current_value) AS DOUBLE) AS current_value
FROM x_growth g LEFT JOIN (SELECT DISTINCT company_key, company_name FROM x_performance) p USING (company_key)
GROUP BY 1, 2, 3, 4
""")
def star_by_filed_date(spark, sf):
    """Growth facts met with the calendar through the inactive filed-date relationship."""
    marts = _report(spark, sf)
    joined = M.star(marts[1], "growth", M.report_companies(*marts), M.report_calendar(*marts), date_role="filed_date")
    return joined.groupBy("company_key", "dim_company_name", "calendar_year", "quarter_number").agg(
        F.count("*").alias("fact_count"), F.sum("current_value").alias("current_value")
    )


@query("star_by_trading_date", """
SELECT company_key, strftime(trading_date, '%Y-%m') AS year_month, count(*) AS day_count, CAST(sum(close) AS DOUBLE) AS close
FROM x_performance GROUP BY 1, 2
""")
def star_by_trading_date(spark, sf):
    marts = _report(spark, sf)
    joined = M.star(marts[0], "performance", M.report_companies(*marts), M.report_calendar(*marts))
    return joined.groupBy("company_key", "year_month").agg(F.count("*").alias("day_count"), F.sum("close").alias("close"))
