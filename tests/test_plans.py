"""Physical plans: no products, no Python, pruned scans, limits before shuffles."""

import re
from datetime import date

import pytest

from tidemark.operators import incremental, measures
from tidemark.plans import standins
from workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_products_and_no_python(spark, capsys, name):
    text = plan_of(QUERIES[name](spark, SF_DIR), capsys)
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "Pandas", "ExistingRDD[company_key"):
        assert operator not in text


@pytest.mark.parametrize("name", ["stg_market_prices", "stg_financial_facts", "stg_macro_observations", "dim_company", "newest_two_per_group"])
def test_newest_rows_are_picked_before_the_shuffle(spark, capsys, name):
    text = plan_of(QUERIES[name](spark, SF_DIR), capsys, "simple")
    assert re.search(r"WindowGroupLimit.*?Partial", text) and re.search(r"WindowGroupLimit.*?Final", text)


def test_scan_reads_only_needed_columns(spark, capsys):
    text = plan_of(QUERIES["watermarks"](spark, SF_DIR), capsys)
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert schemas == ["l_orderkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz"] or schemas == [
        "l_suppkey:bigint,l_shipdate:timestamp_ntz"
    ]


def test_slicer_is_pushed_to_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "mart")
    standins.relations(spark, SF_DIR).mart_company_daily_performance.write.parquet(path)
    period = measures.DayRange(date(1996, 1, 1), date(1996, 12, 31))
    sliced = measures.measure_query(
        spark.read.parquet(path), "market", ["maximum_close"],
        filters={"company_key": ["C0000001"], "trading_date": period}, group_by=["company_key"],
    )
    text = plan_of(sliced, capsys)
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(trading_date,1996-01-01)" in pushed and "LessThan(trading_date,1997-01-01)" in pushed
    assert "EqualTo(company_key,C0000001)" in pushed
    assert re.search(r"ReadSchema: struct<(.*)>", text).group(1).count(":") == 3


def test_performance_mart_shuffles_prices_twice(spark, capsys):
    """Once for the latest version, once by company for lag and names together."""
    relations = standins.relations(spark, SF_DIR)
    text = plan_of(relations.mart_company_daily_performance, capsys, "simple")
    assert len(re.findall(r"Exchange hashpartitioning\(symbol", text)) == 1
    keyed = re.findall(r"Exchange hashpartitioning\(company_key", text)
    assert 1 <= len(keyed) <= 2


def test_history_is_skipped_by_run_range(spark, tmp_path, capsys):
    path = str(tmp_path / "runs")
    standins.price_runs(spark, SF_DIR).write.parquet(path)
    stored = spark.read.parquet(path)
    batch = stored.where("run_id > '19950101T000000001400Z'").select("source", "dataset", "run_id")
    text = plan_of(incremental.same_runs(stored, batch, incremental.run_range(batch)), capsys)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(run_id,19950101T000000001401Z\)", text)


def test_runs_are_verified_without_moving_rows(spark, capsys):
    """Both sides are reduced to a row per run before they are shuffled."""
    text = plan_of(QUERIES["recovery_outcomes"](spark, SF_DIR), capsys)
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    assert len(moved) >= 2
    for columns in moved:
        assert "source_row_number" not in columns and "close" not in columns and "payload" not in columns
