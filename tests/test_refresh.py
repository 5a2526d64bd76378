"""The whole path from payloads to marts, checks and signals on the small data set."""

from datetime import date
from decimal import Decimal

import fixtures as X
import pytest

from tidemark import schemas as S
from tidemark.operators import payloads as P
from tidemark.plans import reference_data, refresh, staging
from tidemark.plans.relations import MARTS, RELATIONS
from tidemark.sources import landing, publish, typed
from tidemark.streaming.arrivals import load_arrivals

AS_OF = date(2025, 3, 2)
EXPECTED = [("AAPL", "0000320193", "primary", True)]


def run(spark, landing, root, daily=False, **options):
    start = refresh.daily_refresh if daily else refresh.refresh
    return start(
        spark, landing, str(root),
        identities=reference_data.company_identities(spark), metrics=reference_data.financial_metrics(spark),
        as_of=AS_OF, expected_identities=EXPECTED, **options,
    )


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    return root, run(spark, X.full_landing(spark), root)


def test_performance_mart(done):
    rows = done[1].relations.mart_company_daily_performance.orderBy("trading_date").collect()
    assert [(r.company_key, r.company_name, r.trading_date) for r in rows] == [
        ("AAPL", "Apple Inc.", date(2025, 1, 14)), ("AAPL", "Apple Inc.", date(2025, 1, 15)),
    ]
    first, second = rows
    assert (first.previous_close, first.daily_change, first.daily_return) == (None, None, None)
    assert (second.previous_close, second.daily_change) == (Decimal("52.5"), Decimal("1.05"))
    assert second.daily_return == pytest.approx(53.55 / 52.5 - 1)


def test_growth_mart(done):
    rows = done[1].relations.mart_company_financial_growth.orderBy("end_date").collect()
    assert [r.current_value for r in rows] == [80, 100]
    assert (rows[1].previous_value, rows[1].absolute_change, rows[1].growth_rate) == (80, 20, 0.25)
    assert rows[1].metric_key == "contract_revenue_excluding_assessed_tax"


def test_macro_mart(done):
    rows = done[1].relations.mart_market_macro.orderBy("trading_date").collect()
    assert [(r.series_id, r.macro_observation_date, r.macro_value, r.macro_age_days) for r in rows] == [
        ("DFF", date(2024, 11, 20), Decimal("3.75"), 55), ("DFF", date(2025, 1, 15), Decimal("3.5"), 0),
    ]


def test_all_checks_pass(done):
    checks = done[1].checks.collect()
    assert len(checks) > 40
    assert [c.check for c in checks if c.status != "pass"] == []


def test_unmapped_concept_stays_in_staging(done):
    relations = done[1].relations
    assert relations.stg_financial_facts.where("concept = 'Goodwill'").count() == 1
    assert relations.fact_financial_reported.where("concept = 'Goodwill'").count() == 0


def test_signals(done):
    signals = {(s.check_id, s.entity_id, s.dataset): s for s in done[1].signals.collect()}
    assert len(signals) == 6 + 5 + 6 + 6 + 5
    seen = signals["market_latest_trading_date", "AAPL", "daily_market_prices"]
    assert [(m.name, m.value) for m in seen.measurements] == [("latest_date", "2025-01-15"), ("age_calendar_days", "46")]
    empty = signals["market_latest_trading_date", "MSFT", "daily_market_prices"]
    assert empty.status == "info" and empty.message == "No loaded Market observations for this symbol."


def test_stored_and_published(spark, done):
    root, result = done
    assert publish.read_mart(spark, result.paths["mart_market_macro"]).count() == 2
    names = result.relations.register_views(spark, "t_")
    assert names == [f"t_{n}" for n in RELATIONS]
    assert spark.table("t_mart_market_macro").count() == 2
    extract = publish.report_extract(result.relations.mart_company_financial_growth)
    assert dict(extract.dtypes)["current_value"] == "double"
    assert {r.metric_short_name for r in extract.collect()} == {"Revenue"}
    counts = {r.table: r.row_count for r in publish.row_counts({m: result.relations[m] for m in MARTS}).collect()}
    assert counts == {m: 2 for m in MARTS}


def test_exact_replay_adds_nothing(spark, tmp_path):
    landing = X.full_landing(spark)
    first = refresh.load(spark, landing, str(tmp_path))
    assert (first.registered.count(), first.quarantine.count()) == (5, 0)
    again = refresh.load(spark, landing, str(tmp_path))
    assert again.registered.count() == 0
    assert outcomes(again) == {(d, "replayed", None) for _, d in S.DATASETS}
    tables = typed.read_source_tables(spark, str(tmp_path))
    assert {n: t.count() for n, t in tables.items()} == {
        "ingestion_runs": 5, "market_daily_prices": 2, "sec_submissions": 1, "sec_company_facts": 3,
        "fred_series_metadata": 1, "fred_series_observations": 2,
    }
    for contract in S.CONTRACTS.values():
        assert tables[contract.name].schema.names == contract.schema.names


def outcomes(result):
    return {(r.dataset, r.disposition, r.reason) for r in result.dispositions.collect()}


def test_altered_replay_is_refused_and_others_load(spark, tmp_path):
    refresh.load(spark, X.full_landing(spark), str(tmp_path))
    changed = X.landing(spark, [
        (S.PRICES, "AAPL", X.RUN_1, X.prices(values=[X.price("2024-12-31", "1", "1", "1", "1", "1")])),
        (S.PRICES, "MSFT", X.RUN_2, X.prices("MSFT")),
    ])
    result = refresh.load(spark, changed, str(tmp_path), tables=["market_daily_prices"])
    assert {(r.entity, r.disposition, r.reason) for r in result.dispositions.collect()} == {
        ("AAPL", "refused", "differs from the registered run in record_count, source_row_count"),
        ("MSFT", "loaded", None),
    }
    assert [r.run_id for r in result.registered.collect()] == [r.run_id for r in changed.where("entity = 'MSFT'").collect()]


def test_half_a_pair_waits_for_the_other(spark, tmp_path):
    first = refresh.load(spark, X.landing(spark, [(S.SUBMISSIONS, "0000320193", X.RUN_1, X.submissions())]), str(tmp_path))
    assert outcomes(first) == {("submissions", "waiting", "the other half has not arrived")}
    again = refresh.load(spark, X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, X.prices())]), str(tmp_path))
    assert outcomes(again) == {
        ("submissions", "waiting", "the other half has not arrived"), ("daily_market_prices", "loaded", None),
    }
    both = refresh.load(spark, X.landing(spark, [(S.COMPANY_FACTS, "0000320193", X.RUN_1, X.company_facts())]), str(tmp_path))
    assert outcomes(both) == {("submissions", "loaded", None), ("company_facts", "loaded", None)}
    tables = typed.read_source_tables(spark, str(tmp_path))
    assert (tables["sec_submissions"].count(), tables["sec_company_facts"].count()) == (1, 3)
    assert outcomes(refresh.load(spark, X.full_landing(spark), str(tmp_path))) == {
        ("submissions", "replayed", None), ("company_facts", "replayed", None), ("daily_market_prices", "replayed", None),
        ("series_metadata", "loaded", None), ("series_observations", "loaded", None),
    }


def test_broken_half_blocks_only_its_own_entity(spark, tmp_path):
    landing = X.landing(spark, [
        (S.SUBMISSIONS, "0000320193", X.RUN_1, X.submissions()), (S.COMPANY_FACTS, "0000320193", X.RUN_1, "{"),
        (S.PRICES, "AAPL", X.RUN_1, X.prices()), (("elsewhere", "unheard_of"), "AAPL", X.RUN_1, "{}"),
    ])
    result = refresh.load(spark, landing, str(tmp_path))
    assert outcomes(result) == {
        ("submissions", "refused", "the other half was rejected"),
        ("company_facts", "quarantined", "not exactly one strict JSON object"),
        ("daily_market_prices", "loaded", None),
        ("unheard_of", "quarantined", "dataset is not handled by this load"),
    }
    assert result.dispositions.count() == landing.count()


def test_bad_payload_is_quarantined_and_others_load(spark, tmp_path):
    landing = X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, X.prices()), (S.PRICES, "MSFT", X.RUN_1, X.prices("AAPL"))])
    result = refresh.load(spark, landing, str(tmp_path), tables=["market_daily_prices"])
    assert result.registered.count() == 1
    assert [(q.entity, q.reason) for q in result.quarantine.collect()] == [("MSFT", "symbol is not the one asked for")]


def test_empty_payload_registers_a_run_without_rows(spark, tmp_path):
    empty = {"meta": {"symbol": "AAPL", "interval": "1day"}, "values": []}
    result = refresh.load(spark, X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, empty)]), str(tmp_path), tables=["market_daily_prices"])
    assert [r.record_count for r in result.registered.collect()] == [0]


def test_daily_refresh_restates_prices(spark, tmp_path):
    run(spark, X.full_landing(spark), tmp_path)
    revised = X.prices(values=[
        X.price("2025-01-15", "52.6", "55", "52", "54", "950"), X.price("2025-01-16", "54", "57.5", "53.5", "57", None),
    ])
    later = X.landing(spark, [
        (S.PRICES, "AAPL", X.RUN_2, revised),
        (S.SERIES_OBSERVATIONS, "DFF", X.RUN_2, X.observations()),
    ])
    result = run(spark, later, tmp_path, daily=True)
    rows = result.relations.mart_company_daily_performance.orderBy("trading_date").collect()
    assert [(r.close, r.previous_close, r.volume) for r in rows] == [(Decimal("52.5"), None, 830), (54, Decimal("52.5"), 950), (57, 54, None)]
    tables = typed.read_source_tables(spark, f"{tmp_path}/source")
    assert tables["market_daily_prices"].count() == 4
    assert tables["fred_series_observations"].count() == 2
    assert result.checks.where("status <> 'pass'").count() == 0
    full = staging.stg_market_prices(tables["market_daily_prices"], tables["ingestion_runs"])
    assert sorted(result.relations.stg_market_prices.collect()) == sorted(full.select(*result.relations.stg_market_prices.columns).collect())
    asked = {(r.dataset, r.entity): (r.mode, r.start_date) for r in result.requests.collect()}
    assert asked["daily_market_prices", "AAPL"] == ("incremental", date(2025, 1, 13))
    assert asked["daily_market_prices", "MSFT"] == ("full", None)
    assert asked["series_observations", "DFF"] == ("incremental", date(2024, 1, 16))


def test_interrupted_load_is_completed_without_duplicates(spark, tmp_path):
    """Rows written, registry not: repeating the load registers the run and adds no rows."""
    landing = X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, X.prices())])
    paths = typed.create_source_tables(spark, str(tmp_path))
    contract = S.CONTRACTS["market_daily_prices"]
    rows = P.accepted_rows(P.parse(landing, contract.name), contract)
    typed.append_rows(rows, paths[contract.name], contract.schema)
    assert refresh.load(spark, landing, str(tmp_path), tables=[contract.name]).registered.count() == 1
    assert typed.read_source_tables(spark, str(tmp_path))[contract.name].count() == 2


def test_partly_stored_run_is_refused(spark, tmp_path):
    landing = X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, X.prices())])
    paths = typed.create_source_tables(spark, str(tmp_path))
    contract = S.CONTRACTS["market_daily_prices"]
    rows = P.accepted_rows(P.parse(landing, contract.name), contract)
    typed.append_rows(rows.where("source_row_number = 0"), paths[contract.name], contract.schema)
    result = refresh.load(spark, landing, str(tmp_path), tables=[contract.name])
    assert outcomes(result) == {("daily_market_prices", "refused", "rows of the run are stored in part")}


def test_daily_refresh_takes_up_runs_that_others_registered(spark, tmp_path, monkeypatch):
    """Runs of load_arrivals, and of a refresh that stopped after its load, reach staging."""
    run(spark, X.full_landing(spark), tmp_path)
    path, state = f"{tmp_path}/arrived", f"{tmp_path}/state"
    landing.append_payloads(X.landing(spark, [(S.PRICES, "MSFT", X.RUN_2, X.prices("MSFT"))]), path)
    load_arrivals(spark, path, f"{tmp_path}/source", state).awaitTermination()
    later = X.landing(spark, [(S.PRICES, "AAPL", X.RUN_2, X.prices(values=[X.price("2025-01-16", "54", "57.5", "53.5", "57", None)]))])
    with monkeypatch.context() as stopped:
        stopped.setattr(typed, "require_whole_files", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, later, tmp_path, daily=True)
    result = run(spark, later, tmp_path, daily=True)
    assert result.registered.count() == 0
    tables = typed.read_source_tables(spark, f"{tmp_path}/source")
    full = staging.stg_market_prices(tables["market_daily_prices"], tables["ingestion_runs"])
    got = result.relations.stg_market_prices
    assert sorted(got.collect()) == sorted(full.select(*got.columns).collect())
    assert {(r.symbol, r.trading_date) for r in got.collect()} == {
        *[(s, date(2025, 1, d)) for s in ("AAPL", "MSFT") for d in (14, 15)], ("AAPL", date(2025, 1, 16)),
    }
