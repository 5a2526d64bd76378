"""New payload files are loaded once, repeated runs find nothing to do."""

import fixtures as X
import pytest

from tidemark import schemas as S
from tidemark.sources import landing, typed
from tidemark.streaming.arrivals import load_arrivals


def test_arrivals(spark, tmp_path):
    path, tables, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))

    def catch_up():
        query = load_arrivals(spark, path, tables, state, tables=("market_daily_prices",))
        query.awaitTermination()
        stored = typed.read_source_tables(spark, tables)
        return stored["ingestion_runs"].count(), stored["market_daily_prices"].count()

    landing.append_payloads(X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, X.prices())]), path)
    assert catch_up() == (1, 2)
    assert catch_up() == (1, 2)
    landing.append_payloads(X.landing(spark, [(S.PRICES, "MSFT", X.RUN_2, X.prices("MSFT")), (S.PRICES, "WMT", X.RUN_2, "{")]), path)
    assert catch_up() == (2, 4)


@pytest.mark.parametrize("files", [1, 1000])
def test_batches_do_not_change_what_is_loaded(spark, tmp_path, files):
    path, tables, state = (str(tmp_path / n) for n in ("landing", "tables", "state"))
    handled = ("market_daily_prices", "sec_submissions", "sec_company_facts")
    for row in X.full_landing(spark).where("source <> 'fred'").collect():
        landing.append_payloads(spark.createDataFrame([row], S.LANDING_SCHEMA), path)
    load_arrivals(spark, path, tables, state, tables=handled, files_per_batch=files).awaitTermination()
    stored = typed.read_source_tables(spark, tables)
    assert {n: stored[n].count() for n in ("ingestion_runs", *handled)} == {
        "ingestion_runs": 3, "market_daily_prices": 2, "sec_submissions": 1, "sec_company_facts": 3,
    }
