"""Steps that move most rows: what is shuffled, and how often it is computed."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as checks
from tidemark.operators.versions import latest_version, with_provenance
from tidemark.plans import delta, marts, standins
from tidemark.sources.scratch import kept
from workload import QUERIES, deltas, measures, quality

SF_DIR = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_registry_is_not_broadcast_on_the_size_of_its_files(spark):
    rows = spark.range(5).select(F.lit("s").alias("source"), F.lit("d").alias("dataset"), F.col("id").cast("string").alias("run_id"))
    runs = rows.where("run_id < 3").withColumns({"ingested_at": F.current_timestamp(), "loaded_at": F.current_timestamp()})
    joined = with_provenance(rows, runs)
    assert "SortMergeJoin" in _plan(joined) and "BroadcastHashJoin" not in _plan(joined)
    assert joined.count() == 3


def test_prices_nobody_trades_under_leave_before_versions_are_ranked(spark):
    relations = standins.relations(spark, SF_DIR)
    plan = _optimized(relations.mart_company_daily_performance)
    assert plan.count("LeftSemi") == 2
    assert plan.index("row_number") < plan.index("LeftSemi")  # the join lies below the ranking


def _computed(monkeypatch, module) -> Counter:
    counts, kept = Counter(), module.kept

    def counted(name, df):
        counts[name] += 1
        return kept(name, df)

    monkeypatch.setattr(module, "kept", counted)
    return counts


def test_a_delta_builds_its_base_once(spark, monkeypatch):
    counts = _computed(monkeypatch, deltas)
    deltas.delta_daily_performance(spark, SF_DIR)
    # Once for the first build, once for the changed parts.
    assert counts["fact_market_daily"] == counts["dim_company"] == counts["month_closes"] == 2


class _Caught(Exception):
    pass


@pytest.mark.parametrize("query", [deltas.delta_daily_performance, deltas.delta_market_macro])
def test_arriving_prices_do_not_meet_the_registry_again(spark, monkeypatch, query):
    seen = {}

    def caught(before, arrivals, *more):
        seen.update(arrivals, before=before("fact_market_daily", None, ()), days=before("dim_date", None, ()))
        raise _Caught

    monkeypatch.setattr(deltas.delta, "Delta", caught)
    with pytest.raises(_Caught):
        query(spark, SF_DIR)
    assert all("Join" not in _optimized(seen[name]) for name in ("stg_market_prices", "stg_macro_observations", "before", "days"))


def test_a_ranked_relation_in_buckets_is_ranked_again_without_a_shuffle(spark):
    rows = spark.sql("SELECT concat('S', id % 5) AS symbol, id % 7 AS trading_date, id % 3 = 0 AS late, id AS n FROM range(100)")
    stored = kept("fact_market_daily", rows)
    assert stored.dtypes == rows.dtypes and sorted(stored.collect()) == sorted(rows.collect())
    parts = [stored.where(c).drop("late") for c in ("late", "NOT late")]
    ranked = latest_version(parts[0].unionByName(parts[1]), ["symbol", "trading_date"], ["n"])
    assert "Exchange" not in _plan(ranked) and ranked.count() == 35
    closes = stored.groupBy("symbol", F.col("trading_date") % 2).count()
    assert "Exchange" not in _plan(closes)


def test_rows_meet_their_runs_once_for_both_sides(spark):
    price = "'p' AS source, 'd' AS dataset, *"
    prices = spark.sql(f"""SELECT {price} FROM VALUES ('r1', 1L, 'A', DATE'2024-01-01', 1.0BD), ('r2', 1L, 'A', DATE'2024-01-01', 2.0BD),
        ('r3', 1L, 'A', DATE'2024-01-01', 3.0BD), ('r3', 2L, 'A', DATE'2024-01-02', 4.0BD), ('r2', 3L, 'B', DATE'2023-01-01', 5.0BD),
        ('r4', 1L, 'A', DATE'2025-01-01', 6.0BD), ('r9', 1L, 'A', DATE'2026-01-01', 7.0BD), ('r1', 2L, NULL, DATE'2024-01-05', 8.0BD)
        AS t(run_id, source_row_number, symbol, trading_date, close)""")
    prices = prices.withColumns({c: F.col("close") for c in ("open", "high", "low")}).withColumn("volume", F.lit(1))
    facts = spark.sql("""SELECT 'f' AS source, 'd' AS dataset, *, NULL AS start_date, filed_date AS end_date FROM VALUES
        ('f1', 1L, '1', 'old', DATE'2024-02-01'), ('f1', 2L, '1', 'new', DATE'2024-02-02') AS t(run_id, source_row_number, cik, entity_name, filed_date)""")
    observed = spark.sql("""SELECT 'o' AS source, 'd' AS dataset, 'o1' AS run_id, 1L AS source_row_number, 'S' AS series_id,
        DATE'2024-01-01' AS realtime_start, DATE'9999-12-31' AS realtime_end, DATE'2024-01-03' AS observation_date, 1.0BD AS value""")
    # r4 has no instant, r9 is not registered.
    runs = spark.sql("""SELECT *, ingested_at AS loaded_at FROM VALUES ('p', 'd', 'r1', TIMESTAMP'2024-01-01'), ('p', 'd', 'r2', TIMESTAMP'2024-01-02'),
        ('p', 'd', 'r3', TIMESTAMP'2024-02-01'), ('p', 'd', 'r4', NULL), ('f', 'd', 'f1', TIMESTAMP'2024-01-01'), ('o', 'd', 'o1', NULL)
        AS t(source, dataset, run_id, ingested_at)""")
    late = F.lit(False) | ((F.col("source") == "p") & (F.col("ingested_at") >= F.lit("2024-02-01").cast("timestamp")))
    identities = spark.sql("SELECT 'A' AS current_ticker, true AS is_current_registrant UNION ALL SELECT 'B', false")
    tables = {"market_daily_prices": prices, "sec_company_facts": facts, "fred_series_observations": observed}
    arrived = deltas._Arrived(tables, runs, late, identities)

    def closes(rows):
        return sorted((str(r.trading_date), int(r.close)) for r in rows.collect())

    assert closes(arrived.built["fact_market_daily"]) == [("2024-01-01", 2)]
    assert closes(deltas.only_late(arrived.prices)) == [("2024-01-01", 3), ("2024-01-02", 4)]
    assert arrived.built["dim_company"].collect() == [("1", "new")]
    assert arrived.built["dim_macro_series"].collect() == [("S",)]
    bounds = [sorted(str(d) for d in f(arrived.days).first()) for f in (deltas.before_late, deltas.only_late)]
    # The calendar takes every symbol and source.
    assert bounds == [["2023-01-01", "2024-02-02"], ["2024-01-01", "2024-01-02"]]


def test_parts_that_changed_are_not_read_from_before(spark):
    changes = object.__new__(delta.Delta)
    changes._before = lambda *_: pytest.fail("read")
    changes.changed = {"dim_date": ([delta.WHOLE], spark.sql("SELECT DATE'2024-01-01' AS date_day"))}
    assert changes.now("dim_date", [delta.WHOLE]).count() == 1


def test_a_mart_with_all_months_replaced_is_not_built_before(spark, monkeypatch):
    def caught(before, *more):
        month = delta.part(delta.MONTH_CLOSES).alias("m")
        months = [r.m for r in before(delta.MONTH_CLOSES, None, ()).select(month).distinct().collect()]
        plans = [_optimized(before("mart_market_macro", None, without)) for without in (months, months[1:])]
        raise _Caught("lag(" in plans[0], "lag(" in plans[1])

    monkeypatch.setattr(deltas.delta, "Delta", caught)
    with pytest.raises(_Caught) as found:
        deltas.delta_market_macro(spark, SF_DIR)
    assert found.value.args == (False, True)


def test_a_delta_of_facts_reads_no_price_twice(spark, monkeypatch):
    counts = _computed(monkeypatch, deltas)
    deltas.delta_financial_growth(spark, SF_DIR)
    assert counts == {"dim_company": 2}


def test_a_report_computes_each_mart_once(spark, monkeypatch):
    counts = _computed(monkeypatch, standins)
    measures.star_by_trading_date(spark, SF_DIR)
    assert counts == {"mart_company_daily_performance": 1, "mart_company_financial_growth": 1}


def test_payloads_of_one_row_group_are_parsed_by_several_tasks(spark):
    orders = f"{SF_DIR}/orders.parquet"
    assert spark.read.parquet(orders).rdd.getNumPartitions() == 1
    plan = _plan(QUERIES["fact_payload_rows"](spark, SF_DIR))
    assert plan.count("REPARTITION_BY_COL") == 1


@pytest.mark.parametrize("query", [quality.grid_violations, measures.macro_measures_per_day])
def test_prices_are_ranked_once_for_both_marts(spark, monkeypatch, query):
    counts = _computed(monkeypatch, standins)
    plan = _optimized(query(spark, SF_DIR))
    assert counts == {"market": 1}
    assert "l_extendedprice" not in plan


def test_counted_marts_share_their_shuffles(spark):
    # A join that wants a day of every price would make the prices below it others.
    plan = _optimized(standins.relations(spark, SF_DIR).mart_market_macro)
    assert "isnotnull(l_shipdate" not in plan and "<=>" in plan


def test_prices_without_a_day_are_in_no_macro_row(spark):
    performance = spark.sql(
        "SELECT 'C' AS company_key, 'T' AS current_ticker, '1' AS current_cik, 'N' AS company_name, "
        "explode(array(DATE'2024-01-02', NULL)) AS trading_date, 1.0BD AS close, 5L AS volume"
    )
    observed = spark.sql("SELECT 'S' AS series_id, DATE'2024-01-01' AS observation_date, 2.0BD AS value")
    rows = marts.mart_market_macro(performance, observed, performance).collect()
    assert [(str(r.trading_date), r.series_id, r.macro_age_days) for r in rows] == [("2024-01-02", "S", 1)]


def test_bounds_of_the_mart_rank_no_prices(spark):
    plan = _optimized(quality._trading_days(standins.relations(spark, SF_DIR)))
    assert "Window" not in plan and "Join" not in plan


def _grid(spark, ids):
    series = spark.createDataFrame([(x,) for x in ids], "series_id string")
    performance = spark.sql("SELECT 'A' AS company_key, DATE'2024-01-01' AS trading_date UNION ALL SELECT 'B', DATE'2024-01-02'")
    rows = [("A", x) for x in ids if x not in ("S000", "S062", "S129")] + [("A", "Z"), ("D", "S001"), ("D", None)]
    mart = spark.createDataFrame(rows, "company_key string, series_id string").withColumn("trading_date", F.lit("2024-01-01").cast("date"))
    return checks.grid_violations(performance, series, mart)


def test_the_grid_is_reduced_to_bits_before_its_shuffle(spark):
    plan = _optimized(_grid(spark, ["S000", "S001"]))
    assert all("trading_date" not in line for line in plan.splitlines() if "collect_set" in line)
    assert "bit_or" in plan


def test_a_grid_of_more_series_than_bits(spark):
    ids = [f"S{k:03d}" for k in range(130)]
    missing, extra = "series is missing on a traded day", "row is not part of the grid"
    found = [(r.company_key, r.series_id, r.failure_reason) for r in _grid(spark, ids).collect()]
    wanted = [("A", x, missing) for x in ("S000", "S062", "S129")] + [("B", x, missing) for x in ids]
    assert sorted(found) == sorted([*wanted, ("A", "Z", extra), ("D", "S001", extra)])
