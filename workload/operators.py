"""Queries for single operators: as-of join, incremental refresh, replay, layout, functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import numeric, temporal, text
from tidemark.operators import incremental, monitoring, quality, recovery, relational, timeseries, versions
from tidemark.plans import standins
from tidemark.sources import layout, publish
from workload.registry import digits, query

table = standins.table
R = standins.relations


# --- ordered operators ----------------------------------------------------------

@query("asof_join", """
WITH d AS (
  SELECT event_type AS series, CAST(ts AS DATE) - CAST(day(ts) % 4 AS INTEGER) AS day, value, event_id FROM events
  WHERE event_type <> 'purchase'),
s AS (SELECT series, day, arg_max(CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id END, event_id) AS dummy,
  max(event_id) AS last_id FROM d GROUP BY series, day),
m AS (SELECT s.series, s.day, CASE WHEN s.last_id % 5 = 0 THEN NULL ELSE d.value END AS value
  FROM s JOIN d ON d.event_id = s.last_id),
p AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, x.series
  FROM events JOIN (SELECT DISTINCT series FROM d) x ON TRUE WHERE event_type = 'purchase')
SELECT p.user_id, CAST(p.day AS VARCHAR) AS day, p.series, CAST(m.day AS VARCHAR) AS found_day, m.value AS found_value,
  p.day - m.day AS age
FROM p ASOF LEFT JOIN m ON p.series = m.series AND p.day >= m.day
""")
def asof_join(spark, sf):
    """Purchases against the last value of every other event type, NULL values kept.

    The other events move to the first of four days, so that most days have none.
    """
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("day")
    )
    others = events.where(F.col("event_type") != "purchase").withColumn(
        "day", F.date_sub("day", F.dayofmonth("day") % 4)
    )
    series = (
        others.groupBy(F.col("event_type").alias("series"), "day")
        .agg(F.max_by(F.struct("event_id", "value"), "event_id").alias("last"))
        .select("series", F.col("day").alias("at"), F.when(F.col("last.event_id") % 5 != 0, F.col("last.value")).alias("value"))
    )
    # One array of series names; there are only as many as event types.
    names = series.agg(F.collect_set("series")).scalar()
    probes = (
        events.where(F.col("event_type") == "purchase")
        .select("user_id", "day")
        .distinct()
        .select("*", F.explode(names).alias("series"))
    )
    joined = timeseries.asof_join(
        probes, series, by=["series"], left_on="day", right_on="at",
        take={"found_day": "at", "found_value": "value"},
    )
    return joined.withColumn("age", F.datediff("day", "found_day"))


@query("lag_per_key", """
SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date,
  CAST(lag(close) OVER (PARTITION BY symbol ORDER BY trading_date) AS DOUBLE) AS previous_close,
  CAST(lag(trading_date) OVER (PARTITION BY symbol ORDER BY trading_date) AS VARCHAR) AS previous_date,
  row_number() OVER (PARTITION BY symbol ORDER BY trading_date) AS row_num
FROM x_stg_prices
""")
def lag_per_key(spark, sf):
    prices = R(spark, sf).stg_market_prices
    lagged = timeseries.with_previous(
        prices, ["symbol"], "trading_date", {"previous_close": "close", "previous_date": "trading_date"}
    )
    return versions.numbered_oldest_first(lagged, ["symbol"], "trading_date", "row_num").select(
        "symbol", "trading_date", "previous_close", "previous_date", "row_num"
    )


@query("calendar_spine", """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE)::VARCHAR AS date_day
FROM (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS lo, CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) AS hi FROM events)
""")
def calendar_spine(spark, sf):
    days = table(spark, sf, "events").select(F.col("ts").cast("date").alias("day"))
    return timeseries.calendar_spine(timeseries.day_bounds(days, "day"))


@query("newest_two_per_group", """
SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rk FROM orders)
WHERE rk <= 2
""")
def newest_two_per_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return versions.newest_per_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], k=2)


@query("newest_per_priority", """
SELECT DISTINCT ON (o_orderstatus, o_orderpriority) o_orderstatus, o_orderpriority, o_orderkey
FROM orders ORDER BY o_orderstatus, o_orderpriority, o_orderdate DESC, o_orderkey DESC
""")
def newest_per_priority(spark, sf):
    newest = versions.newest_per_group(
        table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    )
    return newest.select("o_orderstatus", "o_orderpriority", "o_orderkey")


# --- predicates and set operations ----------------------------------------------

@query("day_range_slicer", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1996-02-01' AND CAST(o_orderdate AS DATE) < DATE '1997-03-01'
  AND (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '5-LOW'))
""")
def day_range_slicer(spark, sf):
    orders = table(spark, sf, "orders")
    sliced = orders.where(
        temporal.in_day_range(
            F.col("o_orderdate").cast("date"), F.lit(date(1996, 2, 1)), F.lit(date(1997, 2, 28))
        )
    )
    return relational.in_tuples(
        sliced, ["o_orderstatus", "o_orderpriority"], [("F", "1-URGENT"), ("O", "5-LOW")]
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("annual_shape_predicate", """
SELECT period_type, start_date IS NULL AS is_instant, CAST(end_date - start_date AS BIGINT) AS days,
  count(*) AS fact_count,
  count(*) FILTER (CASE period_type WHEN 'duration' THEN end_date - start_date BETWEEN 350 AND 380 ELSE start_date IS NULL END) AS annual_count
FROM x_facts f JOIN x_metrics m USING (taxonomy, concept) GROUP BY ALL
""")
def annual_shape_predicate(spark, sf):
    facts = standins.sec_company_facts(spark, sf).join(R(spark, sf).metrics, ["taxonomy", "concept"])
    shape = temporal.has_annual_shape(F.col("period_type"), F.col("start_date"), F.col("end_date"))
    return facts.groupBy(
        "period_type",
        F.col("start_date").isNull().alias("is_instant"),
        temporal.days_between(F.col("end_date"), F.col("start_date")).alias("days"),
    ).agg(F.count("*").alias("fact_count"), F.count_if(shape).alias("annual_count"))


@query("null_safe_difference", """
SELECT symbol, CAST(trading_date AS VARCHAR) AS trading_date, volume, previous_volume FROM (
  SELECT symbol, trading_date, volume, lag(volume) OVER (PARTITION BY symbol ORDER BY trading_date) AS previous_volume
  FROM x_stg_prices)
WHERE volume IS DISTINCT FROM previous_volume
""")
def null_safe_difference(spark, sf):
    lagged = timeseries.with_previous(
        R(spark, sf).stg_market_prices, ["symbol"], "trading_date", {"previous_volume": "volume"}
    )
    return lagged.where(relational.differs(F.col("volume"), F.col("previous_volume"))).select(
        "symbol", "trading_date", "volume", "previous_volume"
    )


@query("set_difference", """
SELECT l_partkey AS part FROM lineitem EXCEPT SELECT l_partkey - l_partkey % 2 FROM lineitem
""")
def set_difference(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "part")
    even = lines.withColumn("part", F.col("part") - F.col("part") % 2)
    return relational.set_difference(lines, even, ["part"])


@query("anti_join", """
SELECT s_suppkey, s_name FROM supplier s
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_suppkey - l.l_suppkey % 3 = s.s_suppkey)
""")
def anti_join(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    thirds = (F.col("l_suppkey") - F.col("l_suppkey") % 3).alias("s_suppkey")
    return relational.outside_tuples(supplier, table(spark, sf, "lineitem").select(thirds), ["s_suppkey"])


# --- incremental refresh --------------------------------------------------------

@query("watermarks", "SELECT symbol, CAST(max(trading_date) AS VARCHAR) AS watermark FROM x_prices GROUP BY symbol")
def watermarks(spark, sf):
    return incremental.watermarks(standins.market_daily_prices(spark, sf), "symbol", "trading_date")


def _requested(spark, sf):
    """Symbols of all suppliers plus one that has no history for every nation."""
    known = table(spark, sf, "supplier").select(standins.symbol(F.col("s_suppkey")).alias("symbol"))
    new = table(spark, sf, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("symbol"))
    return known.unionByName(new)


@query("refresh_plan", """
SELECT r.symbol, CAST(w.mark AS VARCHAR) AS watermark, CASE WHEN w.mark IS NULL THEN 'full' ELSE 'incremental' END AS mode,
  CAST(w.mark - 3 AS VARCHAR) AS start_date, CAST(NULL AS VARCHAR) AS end_date
FROM (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS symbol FROM supplier
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR) FROM nation) r
LEFT JOIN (SELECT symbol, max(trading_date) AS mark FROM x_prices GROUP BY symbol) w ON w.symbol = r.symbol
""")
def refresh_plan(spark, sf):
    marks = incremental.watermarks(standins.market_daily_prices(spark, sf), "symbol", "trading_date")
    return incremental.refresh_plan(_requested(spark, sf), marks, "symbol", overlap_days=incremental.PRICE_OVERLAP_DAYS)


@query("explicit_refresh_plan", """
SELECT DISTINCT upper(event_type) AS series_id, CAST(max(observation_date) OVER (PARTITION BY series_id) AS VARCHAR) AS watermark,
  'explicit' AS mode, '1996-01-01' AS start_date, '1996-12-31' AS end_date
FROM events JOIN x_obs ON series_id = upper(event_type)
""")
def explicit_refresh_plan(spark, sf):
    observations = standins.fred_series_observations(spark, sf)
    marks = incremental.watermarks(observations, "series_id", "observation_date")
    return incremental.refresh_plan(
        observations.select("series_id").distinct(), marks, "series_id",
        overlap_days=incremental.OBSERVATION_OVERLAP_DAYS, start=date(1996, 1, 1), end=date(1996, 12, 31),
    )


@query("rows_within_plan", """
SELECT p.symbol, CAST(p.trading_date AS VARCHAR) AS trading_date, p.source_row_number, CAST(p.close AS DOUBLE) AS close
FROM x_prices p JOIN (SELECT symbol, max(trading_date) AS mark FROM x_prices GROUP BY symbol) w ON w.symbol = p.symbol
WHERE p.trading_date >= w.mark - 3
""")
def rows_within_plan(spark, sf):
    prices = standins.market_daily_prices(spark, sf)
    marks = incremental.watermarks(prices, "symbol", "trading_date")
    plan = incremental.refresh_plan(_requested(spark, sf), marks, "symbol", overlap_days=3)
    return incremental.within_plan(prices, plan, "symbol", "trading_date").select(
        "symbol", "trading_date", "source_row_number", "close"
    )


@query("entity_plan", """
SELECT upper(trim(c_mktsegment)) || CAST(c_nationkey AS VARCHAR) AS symbol, min(c_custkey) AS position,
  CASE WHEN count(*) > 1 THEN 'duplicate key' END AS problem
FROM customer GROUP BY 1
""")
def entity_plan(spark, sf):
    customers = table(spark, sf, "customer")
    key = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.col("c_nationkey").cast("string"), F.lit("\t"))
    return incremental.entity_plan(customers.select(F.col("c_custkey").alias("position"), key.alias("symbol")), "symbol")


def _snapshots(spark, sf):
    """A current snapshot of older orders and an overlapping batch with some changed prices."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("account"),
        F.col("o_orderkey").alias("item"),
        standins.money("o_totalprice").alias("price"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    current = orders.where(F.col("day") < F.lit(date(1999, 1, 1))).drop("day")
    changed = F.when(F.col("item") % 5 == 0, F.col("price") + 1).otherwise(F.col("price"))
    incoming = orders.where(F.col("day") >= F.lit(date(1997, 1, 1))).withColumn("price", changed).drop("day")
    return current, incoming.withColumn("price", F.col("price").cast("decimal(18,2)"))


_UPSERT = """
WITH o AS (SELECT o_custkey AS account, o_orderkey AS item, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority, CAST(o_orderdate AS DATE) AS day FROM orders),
m AS (SELECT account, item, CASE WHEN day >= DATE '1997-01-01' AND item % 5 = 0 THEN price + 1 ELSE price END AS price, priority,
  CASE WHEN day < DATE '1997-01-01' THEN 'kept' WHEN day >= DATE '1999-01-01' THEN 'inserted'
    WHEN item % 5 = 0 THEN 'updated' ELSE 'unchanged' END AS action FROM o)
"""


@query("upsert_classification", _UPSERT + "SELECT account, item, CAST(price AS DOUBLE) AS price, priority, action FROM m")
def upsert_classification(spark, sf):
    current, incoming = _snapshots(spark, sf)
    return incremental.classify_upsert(current, incoming, ["account", "item"])


@query("upsert_counts", _UPSERT + """
SELECT count(*) FILTER (action = 'inserted') AS inserted, count(*) FILTER (action = 'updated') AS updated,
  count(*) FILTER (action = 'unchanged') AS unchanged, count(*) AS total FROM m
""")
def upsert_counts(spark, sf):
    current, incoming = _snapshots(spark, sf)
    return incremental.upsert_counts(incremental.classify_upsert(current, incoming, ["account", "item"]))


@query("upsert_duplicate_keys", """
SELECT l_orderkey AS account, l_linenumber AS item, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def upsert_duplicate_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("account"), F.col("l_linenumber").alias("item"))
    return incremental.duplicate_keys(lines, ["account", "item"])


def _replayed(spark, sf):
    """Registered: orders before 1999.  Incoming: all orders, some with altered fields."""
    incoming = standins.price_runs(spark, sf)
    key = F.substring("run_id", 10, 12).cast("bigint")
    registry = incoming.where(F.col("ingested_at") < F.lit("1999-01-01").cast("timestamp")).withColumn(
        "record_count", F.when(key % 10 == 0, F.col("record_count") + 1).otherwise(F.col("record_count"))
    ).withColumn("raw_json_path", F.when(key % 15 == 0, F.lit("elsewhere")).otherwise(F.col("raw_json_path")))
    return incoming, registry, incremental.stored_counts(
        standins.market_daily_prices(spark, sf).where(~(F.col("volume").eqNullSafe(F.lit(50)) & (key % 3 == 0)))
    )


@query("replay_verification", """
WITH n AS (SELECT l_orderkey, count(*) AS declared,
    count(*) FILTER (NOT coalesce(l_linenumber <> 7 AND l_quantity = 50 AND l_orderkey % 3 = 0, FALSE)) AS stored
  FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) < DATE '1999-01-01' AS known,
    coalesce(declared, 0) AS declared, coalesce(stored, 0) AS stored
  FROM orders LEFT JOIN n ON l_orderkey = o_orderkey)
SELECT '19950101T' || lpad(CAST(k AS VARCHAR), 12, '0') || 'Z' AS run_id, declared AS record_count,
  CASE WHEN NOT known THEN 'absent' WHEN k % 10 = 0 OR k % 15 = 0 OR stored <> declared THEN 'mismatch'
    ELSE 'verified_replay' END AS state,
  CASE WHEN known THEN concat_ws(',', CASE WHEN k % 15 = 0 THEN 'raw_json_path' END,
    CASE WHEN k % 10 = 0 THEN 'record_count' END, CASE WHEN stored <> declared THEN 'source_row_count' END) ELSE '' END AS mismatched
FROM j
""")
def replay_verification(spark, sf):
    return incremental.classify_runs(*_replayed(spark, sf)).select(
        "run_id", "record_count", "state", F.concat_ws(",", "mismatched").alias("mismatched")
    )


@query("run_registration", """
SELECT '19950101T' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || 'Z' AS run_id, coalesce(n, 0) AS record_count,
  '2002-01-01 00:00:00' AS loaded_at
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
WHERE CAST(o_orderdate AS DATE) >= DATE '1999-01-01'
""")
def run_registration(spark, sf):
    incoming, registry, _ = _replayed(spark, sf)
    new = incremental.register(incoming, registry, F.lit("2002-01-01").cast("timestamp"))
    return new.select("run_id", "record_count", "loaded_at")


@query("paired_load_states", """
WITH b AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders)
SELECT '19950101T' || lpad(CAST(k AS VARCHAR), 12, '0') || 'Z' AS run_id,
  CASE WHEN c % 9 = 0 THEN NULL WHEN s = 'P' AND k % 4 = 0 THEN NULL WHEN k % 6 = 0 AND s <> 'O' THEN NULL
    WHEN s = 'O' THEN 'absent' ELSE 'verified_replay' END AS state,
  CASE WHEN c % 9 = 0 THEN 'paired datasets do not share a run'
    WHEN s = 'P' AND k % 4 = 0 THEN 'a paired run is not an exact replay'
    WHEN k % 6 = 0 AND s <> 'O' THEN 'pair is partially committed' END AS problem
FROM b
""")
def paired_load_states(spark, sf):
    orders = table(spark, sf, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    base = F.when(status == "O", "absent").otherwise("verified_replay")
    second = F.when((status == "P") & (key % 4 == 0), "mismatch").when(key % 6 == 0, "absent").otherwise(base)

    def side(dataset, state):
        return orders.select(
            F.lit("sec_edgar").alias("source"),
            F.lit(dataset).alias("dataset"),
            standins.order_run(key).alias("run_id"),
            F.col("o_orderdate").cast("date").cast("timestamp").alias("ingested_at"),
            state.alias("state"),
            "o_custkey",
        )

    states = side("submissions", base).unionByName(side("company_facts", second).where("o_custkey % 9 <> 0"))
    return incremental.classify_pairs(states, "submissions", "company_facts", "sec_edgar").drop("source")


@query("load_dispositions", """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus = 'O' AS fresh FROM orders),
h AS (SELECT *, c % 9 <> 0 AS other, c % 9 <> 0 AND c % 17 = 0 AS bad,
    CASE WHEN fresh THEN 'absent' WHEN k % 10 = 3 THEN 'mismatch' ELSE 'verified_replay' END AS s1,
    CASE WHEN fresh OR k % 7 = 2 THEN 'absent' ELSE 'verified_replay' END AS s2,
    CASE WHEN NOT fresh AND k % 10 = 3 THEN 'differs from the registered run in record_count'
      WHEN fresh AND k % 5 = 1 THEN 'rows of the run are stored in part' END AS p1 FROM o),
r AS (
  SELECT k, 'submissions' AS dataset, s1 AS s, CASE WHEN p1 IS NOT NULL THEN p1
      WHEN s1 = 'absent' AND NOT other THEN 'the other half has not arrived'
      WHEN s1 = 'absent' AND bad THEN 'the other half was rejected'
      WHEN other AND NOT bad AND k % 11 = 4 THEN 'the halves carry different instants'
      WHEN other AND NOT bad AND s1 <> s2 THEN 'only one half is registered' END AS reason, FALSE AS bad FROM h
  UNION ALL
  SELECT k, 'company_facts', s2, CASE WHEN bad THEN 'unreadable' WHEN p1 IS NOT NULL THEN 'the other half was refused'
      WHEN k % 11 = 4 THEN 'the halves carry different instants' WHEN s1 <> s2 THEN 'only one half is registered' END, bad
  FROM h WHERE other)
SELECT dataset, '19950101T' || lpad(CAST(k AS VARCHAR), 12, '0') || 'Z' AS run_id, reason,
  CASE WHEN bad THEN 'quarantined' WHEN reason = 'the other half has not arrived' THEN 'waiting'
    WHEN reason IS NOT NULL THEN 'refused' WHEN s = 'absent' THEN 'loaded' ELSE 'replayed' END AS disposition
FROM r
""")
def load_dispositions(spark, sf):
    """Every order as a pair of payloads: new, replayed, altered, half stored, alone, unreadable."""
    orders = table(spark, sf, "orders")
    key, fresh = F.col("o_orderkey"), F.col("o_orderstatus") == "O"
    instant = F.col("o_orderdate").cast("date").cast("timestamp")
    altered, partial = ~fresh & (key % 10 == 3), fresh & (key % 5 == 1)
    unreadable = F.col("o_custkey") % 17 == 0

    def side(dataset, state, mismatched, stored, at):
        return orders.select(
            F.lit("sec_edgar").alias("source"), F.lit(dataset).alias("dataset"), standins.order_run(key).alias("run_id"),
            F.col("o_custkey").cast("string").alias("entity"), at.alias("ingested_at"), state.alias("state"),
            mismatched.alias("mismatched"), stored.alias("stored_count"), F.lit(3).cast("bigint").alias("record_count"), "o_custkey",
        )

    nothing, zero = F.array().cast("array<string>"), F.lit(0).cast("bigint")
    first = side(
        "submissions", F.when(fresh, "absent").when(altered, "mismatch").otherwise("verified_replay"),
        F.when(altered, F.array(F.lit("record_count"))).otherwise(nothing), F.when(partial, 1).otherwise(0).cast("bigint"), instant,
    )
    second = side(
        "company_facts", F.when(fresh | (key % 7 == 2), "absent").otherwise("verified_replay"), nothing, zero,
        F.when(key % 11 == 4, instant + F.expr("INTERVAL 1 DAY")).otherwise(instant),
    ).where("o_custkey % 9 <> 0")
    states = first.unionByName(second.where(~unreadable))
    rejected = second.where(unreadable).withColumn("reason", F.lit("unreadable"))
    found = incremental.run_dispositions(
        states, rejected, [("sec_edgar", "submissions", "company_facts")], [S.SUBMISSIONS, S.COMPANY_FACTS]
    )
    return found.select("dataset", "run_id", "disposition", "reason")


@query("paired_runs", """
SELECT 'CUST' || CAST(o_custkey AS VARCHAR) AS entity, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00' AS ingested_at,
  count(*) FILTER (o_orderkey % 2 = 0) AS first_runs, count(*) FILTER (o_orderkey % 2 = 1) AS second_runs,
  count(DISTINCT o_orderkey // 2) AS run_ids
FROM orders GROUP BY 1, 2
HAVING count(*) FILTER (o_orderkey % 2 = 0) <> 1 OR count(*) FILTER (o_orderkey % 2 = 1) <> 1 OR count(DISTINCT o_orderkey // 2) <> 1
""")
def paired_runs(spark, sf):
    runs = table(spark, sf, "orders").select(
        F.lit("fred").alias("source"),
        F.concat(F.lit("CUST"), F.col("o_custkey").cast("string")).alias("entity"),
        F.when(F.col("o_orderkey") % 2 == 0, "series_metadata").otherwise("series_observations").alias("dataset"),
        F.floor(F.col("o_orderkey") / 2).cast("string").alias("run_id"),
        F.col("o_orderdate").cast("date").cast("timestamp").alias("ingested_at"),
    )
    return recovery.paired_runs(runs, "series_metadata", "series_observations").drop("source")


# --- layout ---------------------------------------------------------------------

@query("run_ids", """
SELECT o_orderkey, strftime(t, '%Y%m%dT%H%M%S') || lpad(CAST(microsecond(t) % 1000000 AS VARCHAR), 6, '0') || 'Z--entity-'
    || replace(replace(rtrim(to_base64(CAST(e AS BLOB)), '='), '+', '-'), '/', '_') AS run_id,
  e AS decoded, strftime(t, '%Y-%m-%d %H:%M:%S') AS instant, TRUE AS well_formed
FROM (SELECT o_orderkey, o_orderdate + to_microseconds(o_orderkey * 1000003) AS t,
  o_orderpriority || '?>' || CAST(o_custkey AS VARCHAR) AS e FROM orders)
""")
def run_ids(spark, sf):
    at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(F.col("o_orderkey") * 1000003 / 1000000).cast("decimal(18,6)"))
    entity = F.concat(F.col("o_orderpriority"), F.lit("?>"), F.col("o_custkey").cast("string"))
    made = table(spark, sf, "orders").select("o_orderkey", text.run_id(at, entity).alias("run_id"))
    return made.select(
        "*",
        text.run_entity(F.col("run_id")).alias("decoded"),
        text.run_instant(F.col("run_id")).alias("instant"),
        F.col("run_id").rlike(S.RUN_ID_PATTERN).alias("well_formed"),
    )


def _artifacts(spark, sf):
    """Artifact paths of one run per order; some lack the typed file, some hold a stray."""
    orders = table(spark, sf, "orders")
    directory = layout.run_directory(
        "/lake", F.lit("feed"), F.regexp_replace(F.lower("o_orderpriority"), "[^a-z]", ""),
        F.col("o_orderdate").cast("timestamp"), F.concat(F.lit("E"), F.col("o_orderkey").cast("string")),
    )
    names = F.array_compact(
        F.array(
            F.when(F.col("o_orderkey") % 11 != 0, F.lit(layout.RAW_NAME)),
            F.when(F.col("o_orderkey") % 3 != 0, F.lit(layout.TYPED_NAME)),
            F.when(F.col("o_orderkey") % 13 == 0, F.lit("notes.txt")),
        )
    )
    listed = orders.select(directory.alias("directory"), F.explode(names).alias("name"))
    return listed.select(F.concat_ws("/", "directory", "name").alias("path"))


_MANIFEST = """
WITH f AS (SELECT regexp_replace(lower(o_orderpriority), '[^a-z]', '', 'g') AS dataset, CAST(o_orderdate AS DATE) AS d,
    o_orderkey % 11 <> 0 AS raw_present, o_orderkey % 3 <> 0 AS typed_present, o_orderkey % 13 = 0 AS stray,
    'E' || CAST(o_orderkey AS VARCHAR) AS entity,
    strftime(o_orderdate, '%Y%m%d') || 'T000000000000Z--entity-'
      || rtrim(to_base64(CAST('E' || CAST(o_orderkey AS VARCHAR) AS BLOB)), '=') AS run_id
  FROM orders WHERE o_orderkey % 11 <> 0 OR o_orderkey % 3 <> 0 OR o_orderkey % 13 = 0)
"""


@query("run_manifest", _MANIFEST + """
SELECT 'feed' AS source, dataset, run_id, CAST(d AS VARCHAR) AS ingestion_date, raw_present, typed_present,
  CAST(stray AS BIGINT) AS stray_count, entity, CAST(d AS VARCHAR) || ' 00:00:00' AS ingested_at FROM f
""")
def run_manifest(spark, sf):
    return layout.manifest(_artifacts(spark, sf))


@query("latest_runs", _MANIFEST + """
SELECT 'feed' AS source, dataset, arg_max(run_id, (d, run_id)) AS latest_run_id,
  arg_max(raw_present AND typed_present, (d, run_id)) AS latest_pair_present, count(*) AS run_count
FROM f GROUP BY dataset
""")
def latest_runs(spark, sf):
    return layout.latest_runs(layout.manifest(_artifacts(spark, sf)))


# --- functions over table text --------------------------------------------------

@query("key_normalisation", """
SELECT c_custkey, upper(c_mktsegment) AS symbol, nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, '') AS label,
  CASE WHEN c_custkey > 0 AND c_custkey % 5 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS cik,
  c_custkey % 7 <> 0 AS is_accession
FROM customer
""")
def key_normalisation(spark, sf):
    key = F.col("c_custkey")
    digits = F.when(key % 5 == 0, F.concat(key.cast("string"), F.lit("x"))).otherwise(key.cast("string"))
    accession = F.concat(F.lpad(key.cast("string"), 10, "0"), F.lit("-24-"), F.lpad(key.cast("string"), 6, "0"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        text.normalised_symbol(F.concat(F.lit("\t "), F.lower("c_mktsegment"), F.lit(" "))).alias("symbol"),
        text.blank_to_null(F.when(key % 3 == 0, F.lit(" \t")).otherwise(F.concat(F.lit(" "), "c_mktsegment"))).alias("label"),
        text.cik10(digits).alias("cik"),
        text.is_accession(F.when(key % 7 == 0, F.concat(accession, F.lit("\n"))).otherwise(accession)).alias("is_accession"),
    )


@query("strict_dates", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS strict,
  CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') END AS instant
FROM orders
""")
def strict_dates(spark, sf):
    day = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey") % 4
    written = (
        F.when(k == 0, day.cast("string"))
        .when(k == 1, F.date_format(day, "yyyy-M-d "))
        .when(k == 2, F.concat(F.year(day).cast("string"), F.lit("-02-30")))
        .otherwise(F.concat(day.cast("string"), F.lit("T00:00")))
    )
    zone = F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.lit("+0530"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        temporal.strict_date(written).alias("strict"),
        temporal.strict_instant(F.concat(day.cast("string"), F.lit("T00:00:00"), zone)).alias("instant"),
    )


@query("exact_decimals", """
SELECT event_id, CASE WHEN event_id % 6 < 4 AND event_id % 6 <> 2
    THEN CAST(CAST(CAST(value AS DECIMAL(18,2)) * CASE WHEN event_id % 6 = 1 THEN 100 ELSE 1 END AS DECIMAL(38,10)) AS VARCHAR) END AS amount,
  event_id % 6 < 4 AND event_id % 6 <> 2 AS fits, event_id % 6 = 5 AS missing
FROM events
""")
def exact_decimals(spark, sf):
    k = F.col("event_id") % 6
    plain = standins.money("value").cast("string")
    written = (
        F.when(k == 0, F.concat(F.lit(" +"), plain))
        .when(k == 1, F.concat(plain, F.lit("E2")))
        .when(k == 2, F.concat(plain, F.lit("0000000001")))
        .when(k == 3, F.concat(plain, F.lit("000000000000")))
        .when(k == 4, F.lit("NaN"))
        .otherwise(F.lit("."))
    )
    value = table(spark, sf, "events").select("event_id", written.alias("w"))
    return value.select(
        "event_id",
        F.when(numeric.fits_exactly(F.col("w"), 38, 10), digits(numeric.to_decimal(F.col("w"), 38, 10))).alias("amount"),
        numeric.fits_exactly(F.col("w"), 38, 10).alias("fits"),
        numeric.is_missing(F.col("w")).alias("missing"),
    )


@query("change_metrics", """
WITH s AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) - 500 AS cur,
  CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 10 - 4 AS DECIMAL(18,2)) END AS prev FROM customer)
SELECT c_custkey, CAST(cur - prev AS DOUBLE) AS change,
  CASE WHEN prev <> 0 THEN CAST(cur AS DOUBLE) / CAST(prev AS DOUBLE) - 1.0::DOUBLE END AS simple_return,
  CASE WHEN prev <> 0 THEN CAST(cur - prev AS DOUBLE) / abs(CAST(prev AS DOUBLE)) END AS growth_rate,
  CASE WHEN prev <> 0 THEN (CAST(cur AS DOUBLE) - CAST(prev AS DOUBLE)) / CAST(prev AS DOUBLE) * 100 END AS percent_delta,
  CASE WHEN prev <> 0 THEN CAST(cur AS DOUBLE) / CAST(prev AS DOUBLE) END AS ratio, cur < 0 AS is_negative
FROM s
""")
def change_metrics(spark, sf):
    key = F.col("c_custkey")
    pairs = table(spark, sf, "customer").select(
        "c_custkey",
        (standins.money("c_acctbal") - 500).cast(S.VALUE).alias("cur"),
        F.when(key % 7 != 0, key % 10 - 4).cast(S.VALUE).alias("prev"),
    )
    cur, prev = F.col("cur"), F.col("prev")
    return pairs.select(
        "c_custkey",
        numeric.exact_difference(cur, prev, 10).alias("change"),
        numeric.simple_return(cur, prev).alias("simple_return"),
        numeric.growth_rate(cur, prev, 10).alias("growth_rate"),
        numeric.percent_delta(cur, prev).alias("percent_delta"),
        numeric.divide(cur, prev).alias("ratio"),
        (cur < 0).alias("is_negative"),
    )


@query("counts_and_flags", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN user_id WHEN event_id % 4 = 1 THEN event_id END AS counted,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
FROM events
""")
def counts_and_flags(spark, sf):
    k = F.col("event_id") % 4
    written = (
        F.when(k == 0, F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
        .when(k == 1, F.concat(F.lit("+00"), F.col("event_id").cast("string")))
        .when(k == 2, F.concat(F.lit("-1"), F.col("user_id").cast("string")))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".0")))
    )
    parsed = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, sf, "events").select(
        "event_id", numeric.non_negative_count(written).alias("counted"), parsed.alias("k")
    )


@query("representative_name", """
SELECT s_nationkey, arg_max(s_name, (CAST(s_acctbal AS DECIMAL(18,2)), s_suppkey)) AS name FROM supplier GROUP BY 1
""")
def representative_name(spark, sf):
    supplier = table(spark, sf, "supplier").withColumn("balance", standins.money("s_acctbal"))
    return versions.latest_version(supplier, ["s_nationkey"], ["balance", "s_suppkey"]).select(
        "s_nationkey", F.col("s_name").alias("name")
    )


@query("json_rows", """
SELECT '{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"day":"' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
  || '","priority":' || CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || '}' AS json
FROM orders
""")
def json_rows(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    return publish.as_json(orders)


# --- monitoring -----------------------------------------------------------------

AS_OF = date(2002, 1, 1)


def _monitored(spark, sf):
    return _requested(spark, sf).unionByName(
        table(spark, sf, "region").select(F.lit(" ").alias("symbol")).distinct()
    )


def _recency(spark, sf):
    return monitoring.recency_signals(
        standins.market_daily_prices(spark, sf), "symbol", "trading_date", _monitored(spark, sf),
        check_id="market_latest_trading_date", identity=S.PRICES, as_of=AS_OF,
    )


@query("recency_signals", """
SELECT CASE WHEN r.symbol <> ' ' THEN r.symbol END AS entity_id, CASE WHEN r.symbol = ' ' THEN 'error' ELSE 'info' END AS status,
  CASE WHEN r.symbol <> ' ' THEN CAST(w.mark AS VARCHAR) END AS latest_date,
  CASE WHEN r.symbol <> ' ' THEN CAST(DATE '2002-01-01' - w.mark AS VARCHAR) END AS age,
  CASE WHEN r.symbol = ' ' THEN 'Could not measure recency: the entity key is not valid.'
    WHEN w.mark IS NULL THEN 'No loaded Market observations for this symbol.'
    ELSE 'Market calendar-day age is informational because no exchange calendar or freshness threshold is configured.' END AS message
FROM (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS symbol FROM supplier
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR) FROM nation UNION ALL SELECT ' ') r
LEFT JOIN (SELECT symbol, max(trading_date) AS mark FROM x_prices GROUP BY symbol) w ON w.symbol = r.symbol
""")
def recency_signals(spark, sf):
    signals = _recency(spark, sf)
    return signals.select(
        "entity_id",
        "status",
        F.try_element_at("measurements", F.lit(1))["value"].alias("latest_date"),
        F.try_element_at("measurements", F.lit(2))["value"].alias("age"),
        "message",
    )


def _daily_batches(spark, sf):
    """Runs: one batch per order status, priority and day, with its number of orders."""
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.col("o_orderstatus").alias("source"),
            F.col("o_orderpriority").alias("dataset"),
            F.col("o_orderdate").cast("date").cast("timestamp").alias("ingested_at"),
        )
        .agg(F.count("*").alias("record_count"))
        .withColumn("run_id", text.run_id(F.col("ingested_at")))
    )


@query("run_count_movement", """
WITH b AS (SELECT o_orderstatus AS source, o_orderpriority AS dataset, CAST(o_orderdate AS DATE) AS d, count(*) AS n
  FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY source, dataset ORDER BY d DESC) AS rk FROM b)
SELECT c.source, c.dataset, c.n AS current_record_count, p.n AS previous_record_count, c.n - p.n AS absolute_delta,
  CASE WHEN p.n <> 0 THEN (CAST(c.n AS DOUBLE) - p.n) / p.n * 100 END AS percent_delta,
  strftime(c.d, '%Y%m%d') || 'T000000000000Z' AS current_run_id, strftime(p.d, '%Y%m%d') || 'T000000000000Z' AS previous_run_id
FROM (SELECT * FROM r WHERE rk = 1) c LEFT JOIN (SELECT * FROM r WHERE rk = 2) p USING (source, dataset)
""")
def run_count_movement(spark, sf):
    return monitoring.run_count_movement(_daily_batches(spark, sf)).select(
        "source", "dataset", "current_record_count", "previous_record_count", "absolute_delta", "percent_delta",
        "current_run_id", "previous_run_id",
    )


_DATASETS = [("F", "1-URGENT"), ("O", "5-LOW"), ("P", "2-HIGH"), ("X", "9-NONE")]


@query("run_count_signals", """
WITH b AS (SELECT o_orderstatus AS source, o_orderpriority AS dataset, CAST(o_orderdate AS DATE) AS d, count(*) AS n
  FROM orders WHERE (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '5-LOW'), ('P', '2-HIGH')) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY source, dataset ORDER BY d DESC) AS rk FROM b),
k AS (SELECT * FROM (VALUES ('F', '1-URGENT'), ('O', '5-LOW'), ('P', '2-HIGH'), ('X', '9-NONE')) AS t(source, dataset))
SELECT k.source, k.dataset, CASE WHEN c.source = 'P' THEN 'error' ELSE 'info' END AS status,
  CASE WHEN c.source IS NULL THEN 3 WHEN c.source = 'P' THEN 0 ELSE 9 END AS measurement_count,
  CASE WHEN c.source = 'P' THEN NULL ELSE CAST(c.n AS VARCHAR) END AS current_count
FROM k LEFT JOIN (SELECT * FROM r WHERE rk = 1) c USING (source, dataset)
""")
def run_count_signals(spark, sf):
    runs = _daily_batches(spark, sf).withColumn(
        "record_count", F.when(F.col("source") != "P", F.col("record_count")).otherwise(-1)
    )
    return monitoring.run_count_signals(runs, AS_OF, _DATASETS).select(
        "source", "dataset", "status", F.size("measurements").alias("measurement_count"),
        F.try_element_at("measurements", F.lit(1))["value"].alias("current_count"),
    )


@query("signal_status_counts", """
SELECT s.status, CASE s.status WHEN 'info' THEN (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) + 3
  WHEN 'error' THEN 2 ELSE 0 END AS signal_count
FROM (VALUES ('pass'), ('warning'), ('info'), ('error')) AS s(status)
""")
def signal_status_counts(spark, sf):
    runs = _daily_batches(spark, sf).withColumn(
        "record_count", F.when(F.col("source") != "P", F.col("record_count")).otherwise(-1)
    )
    signals = monitoring.collect_signals(
        [_recency(spark, sf), monitoring.run_count_signals(runs, AS_OF, _DATASETS)]
    )
    return monitoring.status_counts(signals)


@query("latest_provenance", """
WITH b AS (SELECT o_orderstatus AS source, o_orderpriority AS dataset, CAST(o_orderdate AS DATE) AS d, count(*) AS n
  FROM orders GROUP BY ALL),
k AS (SELECT * FROM (VALUES ('F', '1-URGENT'), ('O', '5-LOW'), ('P', '2-HIGH'), ('X', '9-NONE')) AS t(source, dataset))
SELECT k.source, k.dataset, strftime(max(d), '%Y%m%d') || 'T000000000000Z' AS latest_run_id, arg_max(n, d) AS latest_record_count
FROM k LEFT JOIN b USING (source, dataset) GROUP BY 1, 2
""")
def latest_provenance(spark, sf):
    return monitoring.latest_provenance(_daily_batches(spark, sf), _DATASETS).drop("latest_recorded_at")


@query("series_profile", """
SELECT series_id, count(*) AS row_count, count(value) AS numeric_count, count(*) - count(value) AS missing_count,
  CAST(min(observation_date) AS VARCHAR) AS first_date, CAST(max(observation_date) AS VARCHAR) AS last_date
FROM x_obs GROUP BY 1
""")
def series_profile(spark, sf):
    return monitoring.series_profile(standins.fred_series_observations(spark, sf))


@query("operational_status", """
SELECT 'error' AS status, 4 AS checks,
  (SELECT count(*) FROM (SELECT regexp_replace(lower(o_orderpriority), '[^a-z]', '', 'g') FROM orders GROUP BY 1)) AS datasets
""")
def operational_status(spark, sf):
    """Roll-up over runs, provenance, relations and recency; the blank entity key makes it an error."""
    inventory = layout.latest_runs(layout.manifest(_artifacts(spark, sf)))
    standins.price_runs(spark, sf).createOrReplaceTempView("sample_runs")
    relations = monitoring.relation_check(spark, ["sample_runs"])
    checks = monitoring.operational_checks(
        inventory=inventory, relations=relations, signals=_recency(spark, sf),
        provenance=monitoring.latest_provenance(standins.ingestion_runs(spark, sf)),
    )
    datasets = inventory.agg(F.count("*")).scalar()
    return monitoring.overall_status(checks).withColumn("datasets", datasets)


@query("provenance_details", """
WITH p AS (SELECT '19950101T' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || 'Z' AS run FROM orders
  ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC LIMIT 1),
e AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 1)
SELECT 'twelve_data' AS source, 'daily_market_prices' AS dataset, 'ok' AS status, 'run ' || run || ' with 0 records' AS detail FROM p
UNION ALL SELECT 'sec_edgar', 'company_facts', 'ok', 'run ' || run || ' with 0 records' FROM p
UNION ALL SELECT 'fred', 'series_observations', 'ok', 'run ' || strftime(day, '%Y%m%d') || 'T000000000000Z with ' || n || ' records' FROM e
UNION ALL SELECT 'sec_edgar', 'submissions', 'info', 'no run is registered'
UNION ALL SELECT 'fred', 'series_metadata', 'info', 'no run is registered'
""")
def provenance_details(spark, sf):
    return monitoring.provenance_details(monitoring.latest_provenance(standins.ingestion_runs(spark, sf)))


@query("latest_dates", "SELECT user_id, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS latest_date FROM events GROUP BY 1")
def latest_dates(spark, sf):
    events = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"))
    return relational.latest_dates(events, "user_id", "day")


@query("rule_summary", """
SELECT 'duplicate lines' AS "check", (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS violations,
  CASE WHEN (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) = 0 THEN 'pass' ELSE 'error' END AS status
UNION ALL SELECT 'unknown parts', (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)), 'pass'
""")
def rule_summary(spark, sf):
    lines = table(spark, sf, "lineitem")
    return quality.summary(
        {
            "duplicate lines": quality.duplicates(lines, ["l_orderkey", "l_linenumber"]),
            "unknown parts": quality.orphans(lines, table(spark, sf, "part"), ["l_partkey"], ["p_partkey"]),
        }
    )
