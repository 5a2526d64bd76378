"""Payload queries: rows of valid payloads, quarantine of the others, checks against stored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import payloads as P
from tidemark.operators import quality, recovery
from tidemark.plans import standins
from tidemark.schemas import CONTRACTS, RUN_KEY
from tidemark.sources.landing import strict_payloads
from workload.registry import digits, query

_ORDER_RUN = "'19950101T' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || 'Z'"


def verdicts(spark, sf, name):
    return P.parse(standins.PAYLOADS[name](spark, sf), name)


def accepted(spark, sf, name):
    return P.accepted_rows(verdicts(spark, sf, name), CONTRACTS[name]).drop("source", "dataset")


def rejected(spark, sf, name):
    return P.quarantined(verdicts(spark, sf, name)).select("run_id", "entity", "reason")


# Fixed by the planted violations: the first broken rule in check order.
_PRICE_REASON = """
CASE WHEN o_custkey % 23 = 0 THEN 'not exactly one strict JSON object'
  WHEN o_custkey % 19 = 0 THEN 'symbol is not the one asked for'
  WHEN o_custkey % 11 = 0 THEN 'meta.interval differs from 1day'
  WHEN o_orderkey % 4 >= 1 AND o_custkey % 17 = 0 THEN 'high lies below low'
  WHEN o_orderkey % 4 >= 2 AND o_custkey % 13 = 0 THEN 'trading date comes twice' END
"""
_PRICE_ROWS = f"""
SELECT {_ORDER_RUN} AS run_id, CAST(i AS BIGINT) AS source_row_number, 'C' || CAST(o_custkey AS VARCHAR) AS symbol,
  CAST(CAST(o_orderdate AS DATE) + CASE WHEN o_custkey % 13 = 0 THEN 0 ELSE CAST(i AS INTEGER) END AS VARCHAR) AS trading_date,
  CAST(p AS DOUBLE) AS open, CAST(p + 5 AS DOUBLE) AS high, CAST(p - 5 AS DOUBLE) AS low, CAST(p + i AS DOUBLE) AS close,
  o_custkey + i AS volume
FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS p, {_PRICE_REASON} AS reason FROM orders)
JOIN (SELECT unnest([0, 1, 2]) AS i) ON i < o_orderkey % 4
WHERE reason IS NULL
"""


@query("price_payload_rows", _PRICE_ROWS)
def price_payload_rows(spark, sf):
    return accepted(spark, sf, "market_daily_prices")


@query("price_payload_quarantine", f"""
SELECT {_ORDER_RUN} AS run_id, 'C' || CAST(o_custkey AS VARCHAR) AS entity, {_PRICE_REASON} AS reason
FROM orders WHERE {_PRICE_REASON} IS NOT NULL
""")
def price_payload_quarantine(spark, sf):
    return rejected(spark, sf, "market_daily_prices")


@query("price_payload_counts", f"""
SELECT {_ORDER_RUN} AS run_id, o_orderkey % 4 AS record_count FROM orders WHERE {_PRICE_REASON} IS NULL
""")
def price_payload_counts(spark, sf):
    """Payloads without days are valid and count 0."""
    return P.accepted_counts(verdicts(spark, sf, "market_daily_prices")).select("run_id", "record_count")


@query("strict_payload_scan", f"""
SELECT {_ORDER_RUN} AS run_id, 'payload is not strict JSON' AS reason FROM orders WHERE o_custkey % 23 = 0
""")
def strict_payload_scan(spark, sf):
    scanned = strict_payloads(standins.price_payloads(spark, sf))
    return scanned.where("reason IS NOT NULL").select("run_id", "reason")


_FILING_REASON = """
CASE WHEN o_custkey = 0 THEN 'expected cik is invalid'
  WHEN o_custkey % 13 = 0 THEN 'filings.recent has lists of different lengths'
  WHEN o_orderkey % 3 >= 1 AND o_custkey % 17 = 0 THEN 'size has to be a whole number, zero or more' END
"""


@query("filing_payload_rows", f"""
SELECT {_ORDER_RUN} AS run_id, CAST(i AS BIGINT) AS source_row_number, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
  'Customer ' || CAST(o_custkey AS VARCHAR) AS company_name,
  lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || strftime(o_orderdate, '-%y-') || lpad(CAST(i AS VARCHAR), 6, '0') AS accession_number,
  CAST(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS VARCHAR) AS filing_date,
  CASE WHEN i > 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS report_date,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 14:30:00' AS acceptance_datetime,
  CASE WHEN i = 0 THEN '10-K' ELSE '8-K' END AS form, '34' AS act, CAST(NULL AS VARCHAR) AS file_number,
  CAST(NULL AS VARCHAR) AS film_number, '2.02' AS items, o_custkey + i AS size, i = 1 AS is_xbrl, FALSE AS is_inline_xbrl,
  'a.htm' AS primary_document, o_orderpriority AS primary_doc_description
FROM orders JOIN (SELECT unnest([0, 1]) AS i) ON i < o_orderkey % 3
WHERE {_FILING_REASON} IS NULL
""")
def filing_payload_rows(spark, sf):
    return accepted(spark, sf, "sec_submissions")


@query("row_check_violations_filings", f"""
WITH f AS (SELECT {_ORDER_RUN} AS run_id, i AS source_row_number, o_custkey AS c, o_orderkey AS k
  FROM orders JOIN (SELECT unnest([0, 1]) AS i) ON i < o_orderkey % 3 WHERE {_FILING_REASON} IS NULL)
SELECT run_id, CAST(source_row_number AS BIGINT) AS source_row_number, 'size' AS rule FROM f WHERE (c + source_row_number) % 5 = 0
UNION ALL SELECT run_id, source_row_number, 'form_nonblank' FROM f WHERE source_row_number = 1
UNION ALL SELECT run_id, source_row_number, 'cik' FROM f WHERE c % 7 = 0
""")
def row_check_violations_filings(spark, sf):
    rows = P.accepted_rows(verdicts(spark, sf, "sec_submissions"), CONTRACTS["sec_submissions"])
    planted = (
        rows.withColumn("cik", F.when(F.col("cik").cast("bigint") % 7 == 0, F.concat("cik", F.lit("0"))).otherwise(F.col("cik")))
        .withColumn("form", F.when(F.col("source_row_number") == 1, " ").otherwise(F.col("form")))
        .withColumn("size", F.when(F.col("size") % 5 == 0, -1 - F.col("size")).otherwise(F.col("size")))
    )
    return quality.check_violations(planted, "sec_submissions").select("run_id", "source_row_number", "rule")


@query("filing_payload_quarantine", f"""
SELECT {_ORDER_RUN} AS run_id, CAST(o_custkey AS VARCHAR) AS entity, {_FILING_REASON} AS reason
FROM orders WHERE {_FILING_REASON} IS NOT NULL
""")
def filing_payload_quarantine(spark, sf):
    return rejected(spark, sf, "sec_submissions")


_FACT_REASON = """
CASE WHEN o_custkey = 0 THEN 'expected cik is invalid'
  WHEN o_custkey % 19 = 0 THEN 'payload.cik is invalid'
  WHEN o_orderkey % 3 >= 1 AND o_custkey % 13 = 0 THEN 'start lies after end'
  WHEN o_orderkey % 3 >= 1 AND o_custkey % 17 = 0 THEN 'accn is no accession number' END
"""


@query("fact_payload_rows", f"""
SELECT {_ORDER_RUN} AS run_id, CAST(g * (o_orderkey % 3) + i AS BIGINT) AS source_row_number,
  lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, taxonomy, concept, label, ' about it ' AS description, unit,
  CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * scale + i AS DECIMAL(38,10)) AS VARCHAR) AS value, TRUE AS value_exact,
  CASE WHEN i = 0 THEN CAST(CAST(o_orderdate AS DATE) - 364 AS VARCHAR) END AS start_date,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS end_date,
  lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || strftime(o_orderdate, '-%y-') || '000001' AS accession_number,
  year(o_orderdate) AS fiscal_year, 'FY' AS fiscal_period, '10-K' AS form,
  CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS filed_date
FROM orders
JOIN (SELECT unnest([0, 1]) AS i) ON i < o_orderkey % 3
CROSS JOIN (VALUES (0, 'us-gaap', 'NetIncomeLoss', 'Net income', 'USD', 1), (1, 'us-gaap', 'NetIncomeLoss', 'Net income', 'EUR', 2),
  (2, 'us-gaap', 'Assets', 'Assets', 'USD', 3), (3, 'dei', 'SharesOutstanding', NULL, 'shares', 4)) AS c(g, taxonomy, concept, label, unit, scale)
WHERE {_FACT_REASON} IS NULL
""")
def fact_payload_rows(spark, sf):
    rows = accepted(spark, sf, "sec_company_facts").drop("entity_name", "value_text", "frame")
    return rows.withColumn("value", digits(F.col("value")))


@query("fact_payload_quarantine", f"""
SELECT {_ORDER_RUN} AS run_id, CAST(o_custkey AS VARCHAR) AS entity, {_FACT_REASON} AS reason
FROM orders WHERE {_FACT_REASON} IS NOT NULL
""")
def fact_payload_quarantine(spark, sf):
    return rejected(spark, sf, "sec_company_facts")


_SERIES_REASON = """
CASE WHEN c_custkey % 19 = 0 THEN 'seriess holds none or several series'
  WHEN c_custkey % 13 = 0 THEN 'realtime_start lies after realtime_end'
  WHEN c_custkey % 17 = 0 THEN 'last_updated lacks an offset' END
"""
_CUSTOMER_RUN = "'20240101T' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') || 'Z'"


@query("series_payload_rows", f"""
SELECT {_CUSTOMER_RUN} AS run_id, 0 AS source_row_number, c_name AS series_id,
  CAST(DATE '2000-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS VARCHAR) AS realtime_start,
  CAST(DATE '2000-01-01' + CAST(c_custkey % 1000 AS INTEGER) + 10 AS VARCHAR) AS realtime_end, c_mktsegment AS title,
  CAST(DATE '2000-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS VARCHAR) AS observation_start,
  CAST(DATE '2000-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS VARCHAR) AS observation_end,
  'Monthly' AS frequency, 'M' AS frequency_short, 'Percent' AS units, '%' AS units_short, 'None' AS seasonal_adjustment,
  'NSA' AS seasonal_adjustment_short, '2024-01-02 13:31:02' AS last_updated, c_nationkey AS popularity,
  CASE WHEN c_custkey % 2 = 1 THEN 'note' END AS notes
FROM customer WHERE {_SERIES_REASON} IS NULL
""")
def series_payload_rows(spark, sf):
    return accepted(spark, sf, "fred_series_metadata")


@query("row_check_violations_series", f"""
WITH c AS (SELECT {_CUSTOMER_RUN} AS run_id, c_custkey AS k, c_nationkey AS n FROM customer WHERE ({_SERIES_REASON}) IS NULL)
SELECT run_id, 'title_nonblank' AS rule FROM c WHERE k % 4 = 0
UNION ALL SELECT run_id, 'popularity' FROM c WHERE n % 3 = 0
UNION ALL SELECT run_id, 'observation_range' FROM c WHERE k % 5 = 0
""")
def row_check_violations_series(spark, sf):
    rows = P.accepted_rows(verdicts(spark, sf, "fred_series_metadata"), CONTRACTS["fred_series_metadata"])
    key = F.substring("run_id", 10, 12).cast("bigint")
    planted = (
        rows.withColumn("title", F.when(key % 4 == 0, " ").otherwise(F.col("title")))
        .withColumn("popularity", F.when(F.col("popularity") % 3 == 0, -1 - F.col("popularity")).otherwise(F.col("popularity")))
        .withColumn("observation_end", F.when(key % 5 == 0, F.date_sub("observation_start", 1)).otherwise(F.col("observation_end")))
    )
    return quality.check_violations(planted, "fred_series_metadata").select("run_id", "rule")


@query("series_payload_quarantine", f"""
SELECT {_CUSTOMER_RUN} AS run_id, c_name AS entity, {_SERIES_REASON} AS reason FROM customer WHERE {_SERIES_REASON} IS NOT NULL
""")
def series_payload_quarantine(spark, sf):
    return rejected(spark, sf, "fred_series_metadata")


_EVENTS = """
SELECT *, '20240101T' || lpad(CAST(event_id AS VARCHAR), 12, '0') || 'Z' AS run_id, CAST(ts AS DATE) AS d,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 4 AS n FROM events
"""
_OBS_REASON = """
CASE WHEN n >= 1 AND user_id % 13 = 0 THEN 'realtime_start lies after realtime_end'
  WHEN n >= 1 AND user_id % 17 = 0 THEN 'value is no finite decimal'
  WHEN n >= 2 AND user_id % 19 = 0 THEN 'observation comes twice' END
"""


@query("observation_payload_rows", f"""
SELECT run_id, CAST(i AS BIGINT) AS source_row_number, upper(event_type) AS series_id, CAST(d AS VARCHAR) AS realtime_start,
  CAST(d + 1 AS VARCHAR) AS realtime_end, CAST(d + CASE WHEN user_id % 19 = 0 THEN 0 ELSE i END AS VARCHAR) AS observation_date,
  CASE WHEN i < 2 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS value,
  CASE WHEN i < 2 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value_text, TRUE AS value_exact
FROM ({_EVENTS}) JOIN (SELECT unnest([0, 1, 2]) AS i) ON i < n
WHERE {_OBS_REASON} IS NULL
""")
def observation_payload_rows(spark, sf):
    return accepted(spark, sf, "fred_series_observations")


@query("observation_payload_quarantine", f"""
SELECT run_id, upper(event_type) AS entity, {_OBS_REASON} AS reason FROM ({_EVENTS}) WHERE {_OBS_REASON} IS NOT NULL
""")
def observation_payload_quarantine(spark, sf):
    return rejected(spark, sf, "fred_series_observations")


# --- recovery and preflight -----------------------------------------------------

def _stored_prices(spark, sf):
    """Stored rows of the price payloads; some are altered and some runs were never stored."""
    rows = P.accepted_rows(verdicts(spark, sf, "market_daily_prices"), CONTRACTS["market_daily_prices"])
    key = F.substring("run_id", 10, 12).cast("bigint")
    altered = F.when(key % 29 == 0, F.col("volume") + 1).otherwise(F.col("volume"))
    return rows.withColumn("volume", altered).where(key % 5 != 0)


@query("recovery_outcomes", f"""
WITH r AS (SELECT o_orderkey AS k, {_ORDER_RUN} AS run_id, {_PRICE_REASON} AS reason, o_orderkey % 4 AS n FROM orders)
SELECT run_id,
  CASE WHEN k % 31 = 0 OR (k % 5 <> 0 AND k % 7 = 0) OR (k % 7 <> 0 AND reason IS NOT NULL)
      OR (k % 5 <> 0 AND k % 7 <> 0 AND k % 29 = 0 AND n > 0) THEN 'error'
    WHEN k % 7 = 0 AND k % 5 = 0 THEN 'none' WHEN k % 5 = 0 THEN 'rebuilt' ELSE 'verified' END AS outcome,
  CASE WHEN k % 31 = 0 THEN 'run contains unexpected artifacts'
    WHEN k % 5 <> 0 AND k % 7 = 0 THEN 'typed artifact without a payload'
    WHEN k % 7 <> 0 AND reason IS NOT NULL THEN 'payload cannot be parsed: ' || reason
    WHEN k % 5 <> 0 AND k % 29 = 0 AND k % 7 <> 0 AND n > 0 THEN 'typed rows do not match the captured payload' END AS problem
FROM r
""")
def recovery_outcomes(spark, sf):
    orders = standins.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    manifest = orders.select(
        F.lit("twelve_data").alias("source"),
        F.lit("daily_market_prices").alias("dataset"),
        standins.order_run(key).alias("run_id"),
        (key % 7 != 0).alias("raw_present"),
        (key % 5 != 0).alias("typed_present"),
        (key % 31 == 0).cast("int").alias("stray_count"),
    )
    outcomes = recovery.recover_or_verify(
        manifest, standins.price_payloads(spark, sf), _stored_prices(spark, sf),
        P.parse_prices, CONTRACTS["market_daily_prices"],
    )
    return outcomes.select("run_id", "outcome", "problem")


@query("preflight_problems", f"""
WITH r AS (SELECT o_orderkey AS k, {_ORDER_RUN} AS run_id, 'C' || CAST(o_custkey AS VARCHAR) AS entity, o_orderkey % 4 AS n,
    {_PRICE_REASON} AS reason FROM orders)
SELECT run_id,
  CASE WHEN k % 37 = 0 THEN 'raw JSON path is not canonical'
    WHEN k % 5 = 0 AND n <> 0 THEN 'record count does not match the row count'
    WHEN k % 41 = 0 AND n > 0 THEN 'rows do not match the run''s entity' END AS problem
FROM r WHERE reason IS NULL
""")
def preflight_problems(spark, sf):
    counts = P.accepted_counts(verdicts(spark, sf, "market_daily_prices"))
    key = F.substring("run_id", 10, 12).cast("bigint")
    declared = counts.select(
        *RUN_KEY,
        F.when(key % 41 == 0, F.lit("ELSE")).otherwise(F.col("entity")).alias("entity"),
        F.when(key % 37 == 0, F.lit("moved")).otherwise(F.lit("raw")).alias("raw_json_path"),
        F.lit("typed").alias("parquet_path"),
        F.lit("raw").alias("canonical_raw_path"),
        F.lit("typed").alias("canonical_parquet_path"),
        "record_count",
    )
    checked = recovery.preflight(declared, _stored_prices(spark, sf), CONTRACTS["market_daily_prices"])
    return checked.select("run_id", "problem")
