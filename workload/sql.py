"""Shared relations of the SQL side, written independently of the Spark code.

Names start with ``x_`` so they cannot clash with the sample tables.
"""

RELATIONS = {
    "x_metrics": """
SELECT * FROM (VALUES
  ('us-gaap', 'RevenueFromContractWithCustomerExcludingAssessedTax', 'contract_revenue_excluding_assessed_tax',
   'Revenue from Contracts with Customers, Excluding Assessed Tax', 'duration'),
  ('us-gaap', 'NetIncomeLoss', 'net_income_attributable_to_parent', 'Net Income (Loss) Attributable to Parent', 'duration'),
  ('us-gaap', 'Assets', 'total_assets', 'Total Assets', 'instant'),
  ('us-gaap', 'Liabilities', 'total_liabilities', 'Total Liabilities', 'instant'),
  ('us-gaap', 'StockholdersEquity', 'equity_attributable_to_parent', 'Equity Attributable to Parent', 'instant'),
  ('us-gaap', 'NetCashProvidedByUsedInOperatingActivities', 'operating_cash_flow', 'Operating Cash Flow', 'duration')
) AS t(taxonomy, concept, metric_key, metric_name, period_type)
""",
    "x_prices": """
SELECT
  '19950101T' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || 'Z' AS run_id,
  CAST(l_linenumber AS BIGINT) * 100000000000000000 + l_partkey * 100000000
    + CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS source_row_number,
  'S' || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS symbol,
  CAST(l_shipdate AS DATE) AS trading_date,
  CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2)) AS open,
  CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2)) AS high,
  CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2)) * 2 AS low,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS close,
  CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END AS volume,
  CAST(o_orderdate AS DATE) AS ingested_on
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""",
    "x_stg_prices": """
SELECT * FROM (
  SELECT *, row_number() OVER (
    PARTITION BY symbol, trading_date
    ORDER BY ingested_on DESC, run_id DESC, source_row_number DESC) AS rn
  FROM x_prices) WHERE rn = 1
""",
    "x_facts": """
SELECT
  '19950101T' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || 'Z' AS run_id,
  CAST(l_linenumber AS BIGINT) * 100000000000000000 + l_partkey * 100000000
    + CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS source_row_number,
  lpad(CAST(l_suppkey + 1 AS VARCHAR), 10, '0') AS cik,
  'Supplier ' || CAST(l_suppkey AS VARCHAR) || ' as of ' || CAST(year(l_shipdate) AS VARCHAR) AS entity_name,
  'us-gaap' AS taxonomy,
  CASE l_linenumber
    WHEN 1 THEN 'RevenueFromContractWithCustomerExcludingAssessedTax' WHEN 2 THEN 'NetIncomeLoss'
    WHEN 3 THEN 'Assets' WHEN 4 THEN 'Liabilities' WHEN 5 THEN 'StockholdersEquity'
    WHEN 6 THEN 'NetCashProvidedByUsedInOperatingActivities' ELSE 'Unmapped' END AS concept,
  CASE WHEN l_quantity > 45 THEN 'shares' ELSE 'USD' END AS unit,
  CAST(l_extendedprice AS DECIMAL(18,2)) - CASE WHEN l_discount >= 0.09 THEN 90000 ELSE 0 END AS value,
  CASE WHEN l_linenumber NOT IN (3, 4, 5)
    THEN make_date(year(l_shipdate), CASE WHEN l_tax >= 0.08 THEN 7 ELSE 1 END, 1) END AS start_date,
  make_date(year(l_shipdate), 12, 31) AS end_date,
  lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || strftime(l_shipdate, '%y') || '-'
    || lpad(CAST(l_partkey % 1000000 AS VARCHAR), 6, '0') AS accession_number,
  year(l_shipdate) AS fiscal_year,
  CASE WHEN l_linestatus = 'O' THEN 'FY' ELSE 'Q4' END AS fiscal_period,
  CASE l_returnflag WHEN 'A' THEN '10-K' WHEN 'N' THEN '10-K/A' ELSE '10-Q' END AS form,
  CAST(l_shipdate AS DATE) + 45 AS filed_date,
  CASE WHEN l_quantity > 25 THEN 'CY' || CAST(year(l_shipdate) AS VARCHAR) END AS frame,
  CAST(o_orderdate AS DATE) AS ingested_on
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""",
    "x_stg_facts": """
SELECT * FROM (
  SELECT *, row_number() OVER (
    PARTITION BY cik, taxonomy, concept, unit, start_date, end_date, accession_number, fiscal_year,
      fiscal_period, form, filed_date, frame
    ORDER BY ingested_on DESC, run_id DESC, source_row_number DESC) AS rn
  FROM x_facts) WHERE rn = 1
""",
    "x_obs": """
SELECT
  strftime(ts, '%Y%m%d') || 'T000000000000Z' AS run_id,
  event_id AS source_row_number,
  upper(event_type) AS series_id,
  DATE '1995-01-01' + CAST(event_id % 2400 AS INTEGER) + CASE WHEN event_type = 'signup' THEN 730 ELSE 0 END AS observation_date,
  DATE '1995-01-01' + CAST(event_id % 2400 AS INTEGER) + CASE WHEN event_type = 'signup' THEN 730 ELSE 0 END
    + CAST(user_id % 3 AS INTEGER) AS realtime_start,
  CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 17 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS value,
  CAST(ts AS DATE) AS ingested_on
FROM events
""",
    "x_stg_obs": """
SELECT * FROM (
  SELECT *, row_number() OVER (
    PARTITION BY series_id, observation_date, realtime_start
    ORDER BY ingested_on DESC, run_id DESC, source_row_number DESC) AS rn
  FROM x_obs) WHERE rn = 1
""",
    "x_company": """
SELECT cik, entity_name FROM (
  SELECT cik, entity_name, row_number() OVER (
    PARTITION BY cik ORDER BY filed_date DESC, ingested_on DESC, run_id DESC, source_row_number DESC) AS rk
  FROM x_stg_facts) WHERE rk = 1
""",
    "x_identity": """
SELECT
  'C' || lpad(CAST(s_suppkey // 2 AS VARCHAR), 7, '0') AS company_key,
  'S' || lpad(CAST(s_suppkey - s_suppkey % 2 AS VARCHAR), 7, '0') AS current_ticker,
  lpad(CAST(s_suppkey + 1 AS VARCHAR), 10, '0') AS source_cik,
  CASE WHEN s_suppkey % 2 = 0 THEN 'successor' ELSE 'predecessor' END AS registrant_role,
  s_suppkey % 2 = 0 AS is_current_registrant,
  s_nationkey
FROM supplier
""",
    "x_reported": """
SELECT f.*, m.metric_key FROM x_stg_facts f JOIN x_metrics m ON f.taxonomy = m.taxonomy AND f.concept = m.concept
""",
    "x_macro": """
SELECT * FROM (
  SELECT series_id, observation_date, realtime_start, value, row_number() OVER (
    PARTITION BY series_id, observation_date
    ORDER BY realtime_start DESC, ingested_on DESC, run_id DESC, source_row_number DESC) AS rk
  FROM x_stg_obs) WHERE rk = 1
""",
    "x_performance": """
SELECT *, close - previous_close AS daily_change,
  CASE WHEN previous_close <> 0 THEN CAST(close AS DOUBLE) / CAST(previous_close AS DOUBLE) - 1.0::DOUBLE END AS daily_return
FROM (
  SELECT i.company_key, i.current_ticker, i.source_cik AS current_cik, c.entity_name AS company_name,
    p.trading_date, p.open, p.high, p.low, p.close, p.volume,
    lag(p.close) OVER (PARTITION BY i.company_key ORDER BY p.trading_date) AS previous_close
  FROM x_stg_prices p
  JOIN x_identity i ON p.symbol = i.current_ticker AND i.is_current_registrant
  JOIN x_company c ON c.cik = i.source_cik)
""",
    "x_candidates": """
SELECT i.company_key, i.current_ticker, f.cik AS source_cik, f.metric_key, m.metric_name, m.period_type,
  f.taxonomy, f.concept, f.unit, f.fiscal_year, f.start_date, f.end_date, f.value AS current_value,
  f.form, f.filed_date, f.accession_number
FROM x_reported f
JOIN x_identity i ON f.cik = i.source_cik
JOIN x_metrics m ON f.metric_key = m.metric_key
WHERE f.form LIKE '10-K%' AND f.fiscal_period = 'FY'
  AND CASE m.period_type WHEN 'duration' THEN f.end_date - f.start_date BETWEEN 350 AND 380 ELSE f.start_date IS NULL END
""",
    "x_growth": """
SELECT *,
  CASE WHEN end_date - previous_end_date BETWEEN 350 AND 380 THEN current_value - previous_value END AS absolute_change,
  CASE WHEN end_date - previous_end_date BETWEEN 350 AND 380 AND previous_value <> 0
    THEN CAST(current_value - previous_value AS DOUBLE) / abs(CAST(previous_value AS DOUBLE)) END AS growth_rate
FROM (
  SELECT *,
    lag(end_date) OVER (PARTITION BY company_key, metric_key, unit ORDER BY end_date) AS previous_end_date,
    lag(current_value) OVER (PARTITION BY company_key, metric_key, unit ORDER BY end_date) AS previous_value
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY company_key, metric_key, end_date, unit
      ORDER BY filed_date DESC, accession_number DESC, fiscal_year DESC, start_date DESC NULLS LAST, form DESC,
        taxonomy DESC, concept DESC, current_value DESC) AS rk
    FROM x_candidates) WHERE rk = 1)
""",
    "x_aligned": """
SELECT g.company_key, g.current_ticker, g.current_cik, g.company_name, g.trading_date, g.series_id,
  g.market_close, g.market_volume, m.observation_date AS macro_observation_date, m.value AS macro_value,
  g.trading_date - m.observation_date AS macro_age_days
FROM (
  SELECT p.company_key, p.current_ticker, p.current_cik, p.company_name, p.trading_date, s.series_id,
    p.close AS market_close, p.volume AS market_volume
  FROM x_performance p CROSS JOIN (SELECT DISTINCT series_id FROM x_stg_obs) s) g
ASOF LEFT JOIN x_macro m ON g.series_id = m.series_id AND g.trading_date >= m.observation_date
""",
}
