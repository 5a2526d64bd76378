"""Quality queries.  Where a mart is checked against itself, violations are planted first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.operators.timeseries import day_bounds
from tidemark.plans import standins
from tidemark.plans.relations import MARKET
from tidemark.schemas import FACT_GRAIN
from workload.registry import query

table = standins.table
R = standins.relations


@query("not_null_counts", """
SELECT 'volume' AS "column", count(*) FILTER (volume IS NULL) AS null_count FROM x_prices HAVING count(*) FILTER (volume IS NULL) > 0
""")
def not_null_counts(spark, sf):
    return Q.null_counts(standins.market_daily_prices(spark, sf), ["symbol", "trading_date", "close", "volume"])


@query("duplicate_grain", """
SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, count(*) AS row_count FROM x_prices GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_grain(spark, sf):
    return Q.duplicates(standins.market_daily_prices(spark, sf), ["symbol", "trading_date"])


@query("staging_grain_is_unique", """
SELECT cik, taxonomy, concept, unit, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, accession_number,
  CAST(fiscal_year AS BIGINT) AS fiscal_year, fiscal_period, form, CAST(filed_date AS VARCHAR) AS filed_date, frame, count(*) AS row_count
FROM x_stg_facts GROUP BY ALL HAVING count(*) > 1
""")
def staging_grain_is_unique(spark, sf):
    return Q.duplicates(R(spark, sf).stg_financial_facts, FACT_GRAIN)


@query("accepted_values", """
SELECT o_orderpriority, count(*) AS row_count FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1
""")
def accepted_values(spark, sf):
    return Q.unaccepted(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("referential_orphans", """
SELECT o_custkey, count(*) AS row_count FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE CASE WHEN c.c_acctbal > 0 THEN c.c_custkey ELSE -1 - c.c_custkey END = o.o_custkey)
GROUP BY 1
""")
def referential_orphans(spark, sf):
    key = F.col("c_custkey")
    moved = table(spark, sf, "customer").select(F.when(F.col("c_acctbal") > 0, key).otherwise(-1 - key).alias("c_custkey"))
    return Q.orphans(table(spark, sf, "orders"), moved, ["o_custkey"], ["c_custkey"])


def _order_days(spark, sf, step):
    """The days of all orders, moved back so that only every ``step``-th of a month is left."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(F.date_sub(day, F.dayofmonth(day) % step).alias("date_day"))


@query("uncovered_days", """
SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date_day FROM lineitem
WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) - CAST(day(o_orderdate) % 3 AS INTEGER) FROM orders)
""")
def uncovered_days(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return Q.uncovered_days(lines, "day", _order_days(spark, sf, 3))


@query("calendar_gaps", """
SELECT CAST(d AS VARCHAR) AS date_day FROM (
  SELECT d, lead(d) OVER (ORDER BY d) AS nxt FROM (
    SELECT DISTINCT CAST(o_orderdate AS DATE) - CAST(day(o_orderdate) % 3 AS INTEGER) AS d FROM orders))
WHERE nxt IS NOT NULL AND nxt <> d + 1
""")
def calendar_gaps(spark, sf):
    return Q.calendar_gaps(_order_days(spark, sf, 3).distinct())


@query("identity_invariants", """
WITH i AS (
  SELECT CASE WHEN s_nationkey = 3 THEN 'SHARED' ELSE company_key END AS company_key, current_ticker, source_cik,
    CASE WHEN s_nationkey = 7 THEN TRUE ELSE is_current_registrant END AS cur FROM x_identity)
SELECT company_key AS entity_id, 'a company needs one current registrant, no more and no fewer' AS failure_reason
FROM i GROUP BY 1 HAVING count(*) FILTER (cur) <> 1
UNION ALL SELECT current_ticker, 'several companies trade under this ticker today'
FROM i WHERE cur GROUP BY 1 HAVING count(DISTINCT company_key) > 1
UNION ALL SELECT source_cik, 'registrant is assigned to several companies' FROM i GROUP BY 1 HAVING count(DISTINCT company_key) > 1
""")
def identity_invariants(spark, sf):
    supplier = table(spark, sf, "supplier")
    identities = standins.company_identities(spark, sf).join(
        supplier.select(standins.cik(F.col("s_suppkey")).alias("source_cik"), "s_nationkey"), "source_cik"
    )
    nation = F.col("s_nationkey")
    planted = identities.withColumn(
        "company_key", F.when(nation == 3, "SHARED").otherwise(F.col("company_key"))
    ).withColumn("is_current_registrant", (nation == 7) | F.col("is_current_registrant"))
    return Q.identity_violations(planted)


@query("inconsistent_metric_names", """
SELECT p_name AS metric_key FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1
""")
def inconsistent_metric_names(spark, sf):
    part = table(spark, sf, "part")
    return Q.inconsistent_metric_names(part.select(F.col("p_name").alias("metric_key"), F.col("p_type").alias("metric_name")))


@query("daily_metric_violations", """
WITH t AS (SELECT company_key, trading_date, CAST(close AS DOUBLE) AS c, close, daily_change,
    CASE WHEN volume = 13 THEN NULL ELSE previous_close END AS p,
    CASE WHEN volume = 17 THEN daily_return + 0.5 ELSE daily_return END AS r FROM x_performance),
w AS (SELECT *, lag(close) OVER o AS want_p, close - p AS want_change, CASE WHEN p <> 0 THEN c / CAST(p AS DOUBLE) - 1 END AS want_r,
    row_number() OVER o AS row_num
  FROM t WINDOW o AS (PARTITION BY company_key ORDER BY trading_date))
SELECT company_key, CAST(trading_date AS VARCHAR) AS trading_date, row_num FROM w
WHERE p IS DISTINCT FROM want_p
  OR (p IS NOT NULL AND coalesce(abs(daily_change - want_change) > 1e-6, TRUE))
  OR (want_r IS NULL) <> (r IS NULL)
  OR abs(r - want_r) > 1e-6
""")
def daily_metric_violations(spark, sf):
    mart = R(spark, sf).mart_company_daily_performance
    planted = mart.withColumn(
        "previous_close", F.when(~F.col("volume").eqNullSafe(F.lit(13)), F.col("previous_close"))
    ).withColumn(
        "daily_return",
        F.when(F.col("volume") == 17, F.col("daily_return") + 0.5).otherwise(F.col("daily_return")),
    )
    return Q.daily_metric_violations(planted).select("company_key", "trading_date", "row_num")


@query("growth_metric_violations", """
WITH t AS (SELECT company_key, metric_key, end_date, unit, current_value,
    CASE WHEN fiscal_year = 1997 AND unit = 'USD' THEN NULL ELSE previous_end_date END AS previous_end_date,
    CASE WHEN form = '10-K/A' AND fiscal_year = 1998 THEN previous_value + 1 ELSE previous_value END AS previous_value,
    CASE WHEN fiscal_year = 1999 THEN coalesce(absolute_change, 0) + 1 ELSE absolute_change END AS absolute_change,
    CASE WHEN fiscal_year = 2000 THEN NULL ELSE growth_rate END AS growth_rate FROM x_growth),
e AS (SELECT *, lag(end_date) OVER w AS xd, lag(current_value) OVER w AS xv FROM t
  WINDOW w AS (PARTITION BY company_key, metric_key, unit ORDER BY end_date)),
k AS (SELECT *, coalesce(end_date - xd BETWEEN 350 AND 380, FALSE) AS annual, current_value - xv AS diff FROM e),
r AS (SELECT company_key, metric_key, CAST(end_date AS VARCHAR) AS end_date, unit, unnest([
  CASE WHEN previous_end_date IS DISTINCT FROM xd THEN 'previous period end is not that of the period before' END,
  CASE WHEN previous_value IS DISTINCT FROM xv THEN 'previous value is not that of the period before' END,
  CASE WHEN xd IS NULL AND coalesce(CAST(previous_end_date AS VARCHAR), CAST(previous_value AS VARCHAR), CAST(absolute_change AS VARCHAR),
    CAST(growth_rate AS VARCHAR)) IS NOT NULL THEN 'a first period cannot be compared with anything' END,
  CASE WHEN annual AND absolute_change IS DISTINCT FROM diff THEN 'change over one year is not the difference of the values' END,
  CASE WHEN annual AND xv <> 0 AND growth_rate IS DISTINCT FROM CAST(diff AS DOUBLE) / abs(CAST(xv AS DOUBLE))
    THEN 'growth over one year is not the change over the size of the base' END,
  CASE WHEN annual AND xv = 0 AND NOT (growth_rate IS NULL AND absolute_change IS NOT DISTINCT FROM current_value)
    THEN 'growth on a base of zero must stay empty' END,
  CASE WHEN xd IS NOT NULL AND NOT annual AND (coalesce(previous_end_date <> xd, FALSE) OR coalesce(previous_value <> xv, FALSE)
    OR absolute_change IS NOT NULL OR growth_rate IS NOT NULL)
    THEN 'periods a gap apart keep the previous period but no change or growth' END]) AS failure_reason FROM k)
SELECT * FROM r WHERE failure_reason IS NOT NULL
""")
def growth_metric_violations(spark, sf):
    mart = R(spark, sf).mart_company_financial_growth
    year = F.col("fiscal_year")
    planted = mart.select(
        "company_key", "metric_key", "end_date", "unit", "current_value",
        F.when(~((year == 1997) & (F.col("unit") == "USD")), F.col("previous_end_date")).alias("previous_end_date"),
        (F.col("previous_value") + F.when((F.col("form") == "10-K/A") & (year == 1998), 1).otherwise(0))
        .cast("decimal(38,10)").alias("previous_value"),
        F.when(year == 1999, F.coalesce("absolute_change", F.lit(0)) + 1).otherwise(F.col("absolute_change"))
        .cast("decimal(38,10)").alias("absolute_change"),
        F.when(year != 2000, F.col("growth_rate")).alias("growth_rate"),
    )
    return Q.growth_metric_violations(planted)


@query("representative_fact_violations", """
WITH t AS (SELECT company_key, metric_key, end_date, unit, source_cik, period_type, start_date,
    CASE WHEN fiscal_year = 1996 THEN '10-Q' ELSE form END AS form,
    CASE WHEN fiscal_year = 1997 THEN filed_date - 400 ELSE filed_date END AS filed_date,
    CASE WHEN fiscal_year = 1998 THEN 'missing' ELSE accession_number END AS accession_number FROM x_growth),
best AS (SELECT company_key, metric_key, end_date, unit, max((filed_date, accession_number)) AS top,
    list(DISTINCT source_cik || ' ' || accession_number) AS filings
  FROM x_candidates GROUP BY 1, 2, 3, 4),
r AS (SELECT company_key, metric_key, CAST(end_date AS VARCHAR) AS end_date, unit, unnest([
  CASE WHEN NOT coalesce(list_contains(filings, source_cik || ' ' || accession_number), FALSE)
    THEN 'no annual fact of the company stands behind the row' END,
  CASE WHEN form NOT LIKE '10-K%' OR CASE period_type WHEN 'instant' THEN start_date IS NOT NULL
      ELSE coalesce(end_date - start_date NOT BETWEEN 350 AND 380, TRUE) END
    THEN 'form or period length is not annual' END,
  CASE WHEN top > (filed_date, accession_number) THEN 'a later filing reports the same period' END]) AS failure_reason
  FROM t LEFT JOIN best USING (company_key, metric_key, end_date, unit))
SELECT * FROM r WHERE failure_reason IS NOT NULL
""")
def representative_fact_violations(spark, sf):
    relations = R(spark, sf)
    year = F.col("fiscal_year")
    planted = (
        relations.mart_company_financial_growth
        .withColumn("form", F.when(year == 1996, "10-Q").otherwise(F.col("form")))
        .withColumn("filed_date", F.when(year == 1997, F.date_sub("filed_date", 400)).otherwise(F.col("filed_date")))
        .withColumn("accession_number", F.when(year == 1998, "missing").otherwise(F.col("accession_number")))
    )
    return Q.representative_fact_violations(
        planted, relations.fact_financial_reported, relations.identities, relations.dim_financial_metric
    )


_TAMPERED = """
WITH t AS (SELECT company_key, trading_date, series_id,
    CASE WHEN market_volume = 11 THEN macro_observation_date - 1 WHEN market_volume = 12 THEN trading_date + 1
      WHEN market_volume = 13 THEN NULL ELSE macro_observation_date END AS macro_observation_date,
    CASE WHEN market_volume = 14 THEN macro_value + 1 ELSE macro_value END AS macro_value,
    CASE WHEN market_volume = 15 THEN 0 - macro_age_days - 1 ELSE macro_age_days END AS macro_age_days FROM x_aligned),
e AS (SELECT t.*, m.observation_date AS xd, m.value AS xv FROM t
  ASOF LEFT JOIN x_macro m ON t.series_id = m.series_id AND t.trading_date >= m.observation_date)
"""


def _tampered(relations):
    """The mart with planted violations."""
    volume, day = F.col("market_volume"), F.col("macro_observation_date")
    return relations.mart_market_macro.select(
        "company_key", "trading_date", "series_id",
        F.when(volume == 11, F.date_sub(day, 1))
        .when(volume == 12, F.date_add("trading_date", 1))
        .when(volume == 13, None)
        .otherwise(day)
        .alias("macro_observation_date"),
        F.when(volume == 14, (F.col("macro_value") + 1).cast("decimal(38,10)")).otherwise(F.col("macro_value")).alias("macro_value"),
        F.when(volume == 15, -F.col("macro_age_days") - 1).otherwise(F.col("macro_age_days")).alias("macro_age_days"),
    )


def _trading_days(relations):
    """Bounds that hold every trading date of the mart, from one narrow scan of all prices."""
    return day_bounds(relations.trading_days, "trading_date")


@query("alignment_violations", _TAMPERED + """,
r AS (SELECT company_key, CAST(trading_date AS VARCHAR) AS trading_date, series_id, unnest([
  CASE WHEN xd IS DISTINCT FROM macro_observation_date THEN 'observation in force on the day is another one' END,
  CASE WHEN trading_date < macro_observation_date THEN 'observation lies in the future of the day' END,
  CASE WHEN macro_observation_date < xd THEN 'a more recent observation was known' END,
  CASE WHEN macro_observation_date IS NOT NULL AND (coalesce(macro_age_days, -1) < 0 OR macro_observation_date + CAST(macro_age_days AS INTEGER) <> trading_date)
    THEN 'age differs from the days since the observation' END,
  CASE WHEN xd IS NULL AND coalesce(CAST(macro_observation_date AS VARCHAR), CAST(macro_value AS VARCHAR), CAST(macro_age_days AS VARCHAR)) IS NOT NULL
    THEN 'nothing was observed yet, but the row carries values' END]) AS failure_reason FROM e)
SELECT * FROM r WHERE failure_reason IS NOT NULL
""")
def alignment_violations(spark, sf):
    relations = R(spark, sf)
    return Q.alignment_violations(_tampered(relations), relations.fact_macro_observation, _trading_days(relations))


@query("preservation_violations", _TAMPERED + """
SELECT company_key, CAST(trading_date AS VARCHAR) AS trading_date, series_id,
  'date or value differs from the observation in force' AS failure_reason FROM e
WHERE (macro_observation_date, macro_value) IS DISTINCT FROM (xd, xv)
""")
def preservation_violations(spark, sf):
    relations = R(spark, sf)
    return Q.preservation_violations(_tampered(relations), relations.fact_macro_observation, _trading_days(relations))


@query("grid_violations", """
WITH a AS (SELECT company_key, CASE WHEN market_volume = 22 THEN trading_date + 20000 ELSE trading_date END AS trading_date, series_id
  FROM x_aligned WHERE market_volume IS DISTINCT FROM 21 OR series_id <> 'VIEW'),
x AS (SELECT company_key, trading_date, series_id FROM x_aligned)
SELECT company_key, CAST(trading_date AS VARCHAR) AS trading_date, series_id, failure_reason FROM (
  SELECT *, 'series is missing on a traded day' AS failure_reason FROM (SELECT * FROM x EXCEPT SELECT * FROM a)
  UNION ALL SELECT *, 'row is not part of the grid' FROM (SELECT * FROM a EXCEPT SELECT * FROM x))
""")
def grid_violations(spark, sf):
    relations = R(spark, sf, (MARKET,))
    volume = F.col("market_volume")
    planted = relations.mart_market_macro.where(
        ~(volume.eqNullSafe(F.lit(21)) & (F.col("series_id") == "VIEW"))
    ).select(
        "company_key", "series_id",
        F.when(volume == 22, F.date_add("trading_date", 20000)).otherwise(F.col("trading_date")).alias("trading_date"),
    )
    return Q.grid_violations(relations.market, relations.dim_macro_series, planted)


@query("row_check_violations", """
WITH t AS (SELECT run_id, source_row_number, CASE WHEN source_row_number % 7 = 0 THEN ' ' ELSE symbol END AS symbol, open,
    CASE WHEN volume = 10 THEN low - 1 ELSE high END AS high, low, close, CASE WHEN volume = 9 THEN -volume ELSE volume END AS volume,
    CASE WHEN volume = 8 THEN 'other' ELSE 'twelve_data' END AS source FROM x_prices)
SELECT source, run_id, source_row_number, rule FROM (
  SELECT *, 'identity' AS rule FROM t WHERE source <> 'twelve_data'
  UNION ALL SELECT *, 'symbol_nonblank' FROM t WHERE trim(symbol) = ''
  UNION ALL SELECT *, 'volume' FROM t WHERE volume < 0
  UNION ALL SELECT *, 'high_low' FROM t WHERE high < low
  UNION ALL SELECT *, 'high_open' FROM t WHERE high < open
  UNION ALL SELECT *, 'high_close' FROM t WHERE high < close
  UNION ALL SELECT *, 'low_open' FROM t WHERE low > open
  UNION ALL SELECT *, 'low_close' FROM t WHERE low > close)
""")
def row_check_violations(spark, sf):
    volume = F.col("volume")
    planted = (
        standins.market_daily_prices(spark, sf)
        .withColumn("symbol", F.when(F.col("source_row_number") % 7 == 0, " ").otherwise(F.col("symbol")))
        .withColumn("high", F.when(volume == 10, (F.col("low") - 1).cast("decimal(38,18)")).otherwise(F.col("high")))
        .withColumn("source", F.when(volume == 8, "other").otherwise(F.col("source")))
        .withColumn("volume", F.when(volume == 9, -volume).otherwise(volume))
    )
    return Q.check_violations(planted, "market_daily_prices").drop("dataset")


def _broken(sql_rules: list[tuple[str, str]], source: str, columns: str) -> str:
    """SQL of planted row checks: one row for each rule whose condition holds."""
    return " UNION ALL ".join(f"SELECT {columns}, '{rule}' AS rule FROM {source} WHERE {condition}" for rule, condition in sql_rules)


@query("row_check_violations_runs", "WITH t AS (SELECT o_orderkey AS k, '19950101T' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || 'Z' AS r FROM orders),"
    " b AS (SELECT k, CASE WHEN k % 5 = 0 THEN 'x' || r ELSE r END AS run_id FROM t) "
    + _broken([("run_id_format", "k % 5 = 0"), ("parquet_path_nonblank", "k % 13 = 0"), ("artifact_paths_distinct", "k % 7 = 0 AND k % 13 <> 0"),
        ("record_count", "k % 11 = 0")], "b", "run_id"))
def row_check_violations_runs(spark, sf):
    runs = standins.price_runs(spark, sf)
    key = F.substring("run_id", 10, 12).cast("bigint")
    parquet = F.col("parquet_path")
    planted = runs.select(
        "source", "dataset", F.when(key % 5 == 0, F.concat(F.lit("x"), F.col("run_id"))).otherwise(F.col("run_id")).alias("run_id"),
        F.when(key % 7 == 0, parquet).otherwise(F.col("raw_json_path")).alias("raw_json_path"),
        F.when(key % 13 == 0, " ").otherwise(parquet).alias("parquet_path"),
        F.when(key % 11 == 0, F.lit(-1)).otherwise(F.col("record_count")).alias("record_count"),
    )
    return Q.check_violations(planted, "ingestion_runs").select("run_id", "rule")


@query("row_check_violations_facts", _broken(
    [("cik", "fiscal_year = 1996"), ("form_nonblank", "fiscal_year = 1997"), ("unit_nonblank", "unit = 'shares'"),
     ("date_range", "fiscal_year = 1998 AND start_date IS NOT NULL")], "x_facts", "run_id, source_row_number"))
def row_check_violations_facts(spark, sf):
    year = F.col("fiscal_year")
    planted = (
        standins.sec_company_facts(spark, sf)
        .withColumn("cik", F.when(year == 1996, F.substring("cik", 2, 9)).otherwise(F.col("cik")))
        .withColumn("form", F.when(year == 1997, "").otherwise(F.col("form")))
        .withColumn("unit", F.when(F.col("unit") == "shares", "  ").otherwise(F.col("unit")))
        .withColumn(
            "start_date",
            F.when((year == 1998) & F.col("start_date").isNotNull(), F.date_add("end_date", 1)).otherwise(F.col("start_date")),
        )
    )
    return Q.check_violations(planted, "sec_company_facts").select("run_id", "source_row_number", "rule")


@query("row_check_violations_observations", _broken(
    [("series_id_nonblank", "series_id = 'VIEW'"), ("realtime_range", "source_row_number % 7 = 0"), ("identity", "source_row_number % 9 = 0")],
    "x_obs", "run_id, source_row_number"))
def row_check_violations_observations(spark, sf):
    number = F.col("source_row_number")
    planted = (
        standins.fred_series_observations(spark, sf)
        .withColumn("series_id", F.when(F.col("series_id") == "VIEW", " ").otherwise(F.col("series_id")))
        .withColumn("realtime_end", F.when(number % 7 == 0, F.date_sub("realtime_start", 1)).otherwise(F.col("realtime_end")))
        .withColumn("dataset", F.when(number % 9 == 0, "other").otherwise(F.col("dataset")))
    )
    return Q.check_violations(planted, "fred_series_observations").select("run_id", "source_row_number", "rule")


@query("key_violations", """
WITH t AS (SELECT l_orderkey AS k, l_linenumber AS n,
    'S' || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS symbol, CAST(l_shipdate AS DATE) AS d FROM lineitem),
v AS (
  SELECT k, 'primary key' AS "constraint", count(*) AS keys FROM (SELECT k FROM t GROUP BY k, n HAVING count(*) > 1) GROUP BY k
  UNION ALL SELECT k, 'unique grain', count(*) FROM (SELECT k FROM t GROUP BY k, symbol, d HAVING count(*) > 1) GROUP BY k
  UNION ALL SELECT DISTINCT k, 'registered run', 1 FROM t JOIN orders ON o_orderkey = k AND o_orderstatus = 'P')
SELECT '19950101T' || lpad(CAST(k AS VARCHAR), 12, '0') || 'Z' AS run_id, "constraint", keys FROM v
""")
def key_violations(spark, sf):
    prices = standins.market_daily_prices(spark, sf).withColumn(
        "source_row_number", F.floor(F.col("source_row_number") / F.lit(100_000_000_000_000_000)).cast("bigint")
    )
    # Every order is a registered run; those of status P are registered under another instant.
    key = F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") + 500_000_000_000).otherwise(F.col("o_orderkey"))
    runs = table(spark, sf, "orders").select(
        F.lit("twelve_data").alias("source"),
        F.lit("daily_market_prices").alias("dataset"),
        standins.order_run(key).alias("run_id"),
    )
    return Q.key_violations(prices, "market_daily_prices", runs).select("run_id", "constraint", "keys")
