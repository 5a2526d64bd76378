"""Versions that change at once, day folders of typed tables, and refreshes that write touched parts only."""

import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

import fixtures as X
import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import incremental
from tidemark.operators import payloads as P
from tidemark.plans import delta, reference_data, refresh
from tidemark.plans.relations import RELATIONS, Relations
from tidemark.sources import publish, typed
from tidemark.sources.warehouse import Superseded, Warehouse


def files(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet")}


def test_appending_a_day_touches_only_its_folder(spark, tmp_path, capsys):
    contract = S.CONTRACTS["market_daily_prices"]
    path = typed.create_source_tables(spark, str(tmp_path))[contract.name]

    def rows(at):
        return P.accepted_rows(P.parse(X.landing(spark, [(S.PRICES, "AAPL", at, X.prices())]), contract.name), contract)

    typed.append_rows(rows(X.RUN_1), path, contract.schema)
    before = files(path)
    typed.append_rows(rows(X.RUN_2), path, contract.schema)
    new = files(path) - before
    assert before < files(path) and new and all(f.startswith("ingestion_date=2025-03-04/") for f in new)
    one_day = typed.read_table(spark, path, contract.schema, (date(2025, 3, 4), date(2025, 3, 4)))
    assert one_day.count() == 2 and one_day.schema.names == contract.schema.names
    one_day.explain("formatted")
    assert "PartitionFilters: [isnotnull(ingestion_date" in capsys.readouterr().out
    assert typed.read_table(spark, path, contract.schema).count() == 4
    # Other days keep their files when one day is replaced.
    old = {f for f in files(path) if "2025-03-01" in f}
    typed.replace_days(rows(X.RUN_2).where("source_row_number = 0"), path, contract.schema)
    assert old <= files(path) and typed.read_table(spark, path, contract.schema).count() == 3


def test_a_file_beside_the_day_folders_is_refused(spark, tmp_path):
    contract = S.CONTRACTS["market_daily_prices"]
    path = typed.create_source_tables(spark, str(tmp_path))[contract.name]
    landed = X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, X.prices())])
    P.accepted_rows(P.parse(landed, contract.name), contract).write.mode("append").parquet(path)
    with pytest.raises(S.SchemaMismatch, match="outside the day folders"):
        typed.require_whole_files(spark, str(tmp_path))


def test_days_of_run_ids():
    assert typed.days_of(("20250301T1", "20250304T2")) == (date(2025, 3, 1), date(2025, 3, 4))
    assert typed.days_of((None, None)) == typed.days_of(("", "x")) == (None, None)


def test_versions_change_at_once_and_old_ones_stay_readable(spark, tmp_path):
    root = str(tmp_path)
    house = Warehouse(spark, root)
    assert house.current().number == 0 and house.remove_old(0) == []
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, n int")
    first = house.publish(house.current(), {"r": house.write("r", rows, F.col("k"))}, {"x": "1"})
    reader = house.read(first, "r")
    assert sorted(first.relations["r"].parts) == ["a", "b"] and reader.columns == ["k", "n"]
    # Parts b is replaced and a stays; the version counts only when it is published.
    new = house.write("r", spark.createDataFrame([("b", 4), ("c", 5)], "k string, n int"), F.col("k"))
    with pytest.raises(ValueError):
        house.replaced(first.relations["r"], ["b"], new)
    stored = house.replaced(first.relations["r"], ["b", "c"], new)
    assert stored.parts["a"] == first.relations["r"].parts["a"]
    assert sorted(publish.read_mart(spark, f"{root}/r").collect()) == [("a", 1), ("b", 2), ("b", 3)]
    second = house.publish(first, {"r": stored}, {})
    assert sorted(publish.read_mart(spark, f"{root}/r").collect()) == [("a", 1), ("b", 4), ("c", 5)]
    assert sorted(reader.collect()) == [("a", 1), ("b", 2), ("b", 3)]
    assert sorted(house.read(second, "r", ["c"], ()).collect()) == [("c", 5)]
    assert sorted(house.read(second, "r", None, ["c"]).collect()) == [("a", 1), ("b", 4)]
    assert house.read(second, "r", []).columns == ["k", "n"]
    # Somebody else who started from the first version comes too late.
    with pytest.raises(Superseded):
        house.publish(first, {"r": stored}, {})
    assert house.current() == second
    lost = house.write("r", rows, F.col("k"))
    assert house.remove_old(3600) == []
    removed = house.remove_old(0)
    assert "_versions/000000001.json" in removed and next(iter(lost.parts.values())).rpartition("/")[0] in removed
    assert sorted(house.read(house.current(), "r").collect()) == [("a", 1), ("b", 4), ("c", 5)]


IDENTITIES = reference_data.COMPANY_IDENTITIES
CIK = {ticker: cik for _, ticker, cik, *_ in IDENTITIES}


class Lake:
    """Typed rows written run by run, as loads leave them."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, f"{root}/source"
        self.paths = typed.create_source_tables(spark, self.root)
        self.at = datetime(2025, 1, 1, 22, 30, tzinfo=timezone.utc)

    def run(self, table, rows):
        """One run with these rows (without lineage columns)."""
        contract = S.CONTRACTS[table]
        self.at += timedelta(days=1)
        run_id = self.at.strftime("%Y%m%dT%H%M%S000000Z") + f"--entity-{table[:3]}"
        full = [(*contract.identity, run_id, k, *r) for k, r in enumerate(rows)]
        typed.append_rows(self.spark.createDataFrame(full, contract.schema), self.paths[table], contract.schema)
        registry = [(*contract.identity, run_id, self.at, "raw", "typed", len(rows), self.at)]
        typed.append_rows(
            self.spark.createDataFrame(registry, S.INGESTION_RUNS_SCHEMA), self.paths["ingestion_runs"], S.INGESTION_RUNS_SCHEMA
        )


def quote(symbol, day, close):
    close = Decimal(close)
    return (symbol, day, close, close + 1, close - 1, close, 10)


def reported(cik, name, year, value, filed):
    concept = "RevenueFromContractWithCustomerExcludingAssessedTax"
    return (cik, name, "us-gaap", concept, None, None, "USD", Decimal(value), str(value), True, date(year, 1, 1),
            date(year, 12, 31), f"acc-{cik}-{year}-{filed}", year, "FY", "10-K", filed, None)


def observed(series, day, value, since="2025-01-01"):
    return (series, date.fromisoformat(since), date(9999, 12, 31), day, Decimal(value), str(value), True)


def changed_parts(before, after):
    """Parts of every relation that lie in other folders than before."""
    out = {}
    for name, stored in after.relations.items():
        old = before.relations[name].parts
        parts = {p for p in {*old, *stored.parts} if old.get(p) != stored.parts.get(p)}
        if parts:
            out[name] = parts
    return out


def test_delta_refreshes_equal_full_ones_and_write_touched_parts_only(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    lake, house = Lake(spark, tmp_path), Warehouse(spark, f"{tmp_path}/warehouse")
    identities, metrics = reference_data.company_identities(spark), reference_data.financial_metrics(spark)
    symbols = sorted({t for _, t, _, _, current in IDENTITIES if current})[:3]
    # The third symbol does not trade from March to June.
    days = [date(2024, 1, 2) + timedelta(days=5 * k) for k in range(60)]
    history = [quote(s, d, rng.randint(50, 90)) for k, s in enumerate(symbols) for d in days if k < 2 or not 3 <= d.month <= 6]
    lake.run("market_daily_prices", history)
    lake.run("sec_company_facts", [reported(CIK[s], f"{s} Inc.", y, 100 * y, date(y + 1, 2, 1)) for s in symbols for y in (2021, 2022)])
    lake.run("fred_series_observations", [observed(s, date(2024, m, 1), m) for s in ("DFF", "UNRATE") for m in (1, 4, 7)])

    def tables():
        return typed.read_source_tables(spark, lake.root)

    def update():
        return refresh.update_relations(spark, lake.root, identities, metrics, house)

    def same_as_full(version):
        full = Relations(tables(), identities, metrics)
        for name in RELATIONS:
            got = house.read(version, name)
            want = full[name].select(*got.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name

    assert update() is None
    version = refresh.build_relations(tables(), identities, metrics, house)
    assert update() == version

    # A new day in the last month.
    lake.run("market_daily_prices", [quote(symbols[0], date(2024, 10, 25), 77), quote(symbols[1], days[-1], 44)])
    before, version = version, update()
    months = {"2024-10"}
    assert changed_parts(before, version) == {
        "stg_market_prices": months, "fact_market_daily": months, delta.MONTH_CLOSES: months,
        "mart_company_daily_performance": months, "mart_market_macro": months, "staged_runs": {"2025-01"},
        **({"dim_date": {"all"}} if "dim_date" in changed_parts(before, version) else {}),
    }
    reader = house.read(before, "mart_market_macro")
    rows_before = reader.count()

    # The last price of February changes: for the third symbol the next row is in July.
    lake.run("market_daily_prices", [quote(symbols[2], max(d for d in days if d.month == 2), 123)])
    before, version = version, update()
    parts = changed_parts(before, version)
    assert parts["stg_market_prices"] == {"2024-02"}
    assert parts["mart_company_daily_performance"] == parts["mart_market_macro"] == {"2024-02", "2024-07"}
    same_as_full(version)
    assert reader.count() == rows_before

    # An older observation is restated: it is in force from April to the end of June.
    lake.run("fred_series_observations", [observed("DFF", date(2024, 4, 1), 99, "2025-02-01"), observed("DFF", date(2024, 1, 1), 1, "2025-02-01")])
    before, version = version, update()
    parts = changed_parts(before, version)
    assert parts["mart_market_macro"] == {"2024-04", "2024-05", "2024-06"}
    assert "mart_company_daily_performance" not in parts and len(parts["fact_macro_observation"]) == 1

    # New facts touch one company's growth; its name stays.  A refresh that is stopped changes nothing.
    lake.run("sec_company_facts", [reported(CIK[symbols[0]], f"{symbols[0]} Inc.", 2023, 7, date(2024, 2, 1))])
    with monkeypatch.context() as stopped:
        stopped.setattr(Warehouse, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            update()
    assert house.current() == version
    before, version = version, update()
    parts = changed_parts(before, version)
    assert len(parts["mart_company_financial_growth"]) == 1 and "mart_market_macro" not in parts
    same_as_full(version)

    # A company gets another name, a new series appears: all months.
    lake.run("sec_company_facts", [reported(CIK[symbols[1]], "Renamed Inc.", 2023, 8, date(2024, 3, 1))])
    lake.run("fred_series_observations", [observed("GDP", date(2024, 5, 1), 5)])
    before, version = version, update()
    assert changed_parts(before, version)["mart_market_macro"] == set(before.relations["mart_market_macro"].parts)
    same_as_full(version)
    # Other seeds need a full build.
    assert refresh.update_relations(spark, lake.root, identities.where("is_current_registrant"), metrics, house) is None


def outcomes(result):
    return {(r.dataset, r.disposition, r.reason) for r in result.dispositions.collect()}


def test_a_refused_half_is_reported_once_and_waiting_does_not_grow(spark, tmp_path):
    root = str(tmp_path)

    def load(*rows):
        tables = ["market_daily_prices"] if rows[0][0] == S.PRICES else ["sec_submissions", "sec_company_facts"]
        return outcomes(refresh.load(spark, X.landing(spark, list(rows)), root, tables=tables))

    def waiting():
        return refresh.PairState(spark, root).waiting().count()

    cik = "0000320193"
    assert load((S.SUBMISSIONS, cik, X.RUN_1, X.submissions())) == {("submissions", "waiting", "the other half has not arrived")}
    assert waiting() == 1
    assert load((S.COMPANY_FACTS, cik, X.RUN_1, "{")) == {
        ("submissions", "refused", "the other half was rejected"),
        ("company_facts", "quarantined", "not exactly one strict JSON object"),
    }
    assert waiting() == 0
    assert load((S.PRICES, "AAPL", X.RUN_1, X.prices())) == {("daily_market_prices", "loaded", None)}
    settled = refresh.PairState(spark, root).settled().collect()
    assert {(r.dataset, r.disposition) for r in settled} == {("submissions", "refused"), ("company_facts", "quarantined")}
    # The half alone is not waited for any more; both halves together are judged anew.
    assert load((S.COMPANY_FACTS, cik, X.RUN_1, X.company_facts())) == {
        ("company_facts", "refused", "the other half was refused in an earlier load")
    }
    assert waiting() == 0 and refresh.PairState(spark, root).settled().count() == 2
    assert load((S.SUBMISSIONS, cik, X.RUN_1, X.submissions()), (S.COMPANY_FACTS, cik, X.RUN_1, X.company_facts())) == {
        ("submissions", "loaded", None), ("company_facts", "loaded", None),
    }


def test_partner_of_a_dataset(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c"), ("t", "a")], "source string, dataset string")
    assert [r[0] for r in df.select(incremental.partner_of([("s", "a", "b")])).collect()] == ["b", "a", None, None]
