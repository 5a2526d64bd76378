"""Payload parsers: typed rows, provider order, and every rejection rule on a planted payload."""

import copy
import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest

from tidemark import schemas as S
from tidemark.operators import payloads as P

AT = datetime(2025, 3, 1, 12, 0, tzinfo=timezone.utc)


def land(spark, identity, cases):
    """cases: list of (entity, payload object or text)."""
    rows = [
        (*identity, AT.date(), f"20250301T{i:012d}Z", entity, AT, p if isinstance(p, str) else json.dumps(p))
        for i, (entity, p) in enumerate(cases)
    ]
    return spark.createDataFrame(rows, S.LANDING_SCHEMA)


def reasons(spark, parser, identity, cases):
    out = parser(land(spark, identity, cases)).select("run_id", "reason").collect()
    return [r.reason for r in sorted(out, key=lambda r: r.run_id)]


def edited(base, *path, to=None, drop=False):
    value = copy.deepcopy(base)
    node = value
    for step in path[:-1]:
        node = node[step]
    if drop:
        del node[path[-1]]
    else:
        node[path[-1]] = to
    return value


PRICES = {
    "meta": {"symbol": " aapl ", "interval": "1day"},
    "values": [
        {"datetime": "2024-12-31", "open": "101", "high": "104", "low": "100", "close": "103.25", "volume": "1100"},
        {"datetime": "2024-12-30", "open": "100", "high": "1.02e2", "low": "99", "close": "101", "volume": None},
    ],
    "status": "ok",
}


def test_prices_rows(spark):
    verdicts = P.parse_prices(land(spark, S.PRICES, [("AAPL", PRICES), ("MSFT", {"meta": {"symbol": "MSFT", "interval": "1day"}, "values": []})]))
    assert [r.reason for r in verdicts.collect()] == [None, None]
    rows = P.accepted_rows(verdicts, S.CONTRACTS["market_daily_prices"]).orderBy("source_row_number")
    S.require_schema(rows, S.PRICES_SCHEMA)
    got = rows.collect()
    assert [(r.source_row_number, r.symbol, r.trading_date, r.close, r.volume) for r in got] == [
        (0, "AAPL", date(2024, 12, 31), Decimal("103.25"), 1100),
        (1, "AAPL", date(2024, 12, 30), Decimal("101"), None),
    ]
    assert got[1].high == Decimal(102)
    counts = {r.entity: r.record_count for r in P.accepted_counts(verdicts).collect()}
    assert counts == {"AAPL": 2, "MSFT": 0}


def v(field, to):
    return edited(PRICES, "values", 1, field, to=to)


PRICE_REJECTIONS = [
    ("{bad", "not exactly one strict JSON object"),
    ('{"meta": NaN}', "not exactly one strict JSON object"),
    ("[1]", "not exactly one strict JSON object"),
    (json.dumps(PRICES) + "}", "not exactly one strict JSON object"),
    (json.dumps(PRICES) + "]", "not exactly one strict JSON object"),
    (json.dumps(PRICES) + ",0", "not exactly one strict JSON object"),
    (json.dumps(PRICES) + " \n", None),
    (edited(PRICES, "meta", to=5), "meta has to be an object"),
    (edited(PRICES, "meta", "symbol", to="  "), "meta.symbol is blank"),
    (edited(PRICES, "meta", "symbol", to="MSFT"), "symbol is not the one asked for"),
    (edited(PRICES, "meta", "interval", to="1week"), "meta.interval differs from 1day"),
    (edited(PRICES, "values", drop=True), "values has to be a list"),
    (edited(PRICES, "values", to={}), "values has to be a list"),
    (edited(PRICES, "values", 0, to=3), "entry of values has to be an object"),
    (v("datetime", "2024-1-5"), "datetime is not written year-month-day"),
    (v("datetime", 20240105), "datetime is not written year-month-day"),
    (v("datetime", "2024-02-30"), "datetime is no calendar date"),
    (v("datetime", "2024-12-31"), "trading date comes twice"),
    (v("open", " "), "open has to be text with a number"),
    (v("open", 100), "open has to be text with a number"),
    (v("close", "abc"), "close is no finite decimal"),
    (v("close", "NaN"), "close is no finite decimal"),
    (v("high", "98"), "high lies below low"),
    (v("open", "103"), "high lies below open"),
    (v("close", "103"), "high lies below close"),
    (v("open", "98.5"), "low lies above open"),
    (v("close", "98.5"), "low lies above close"),
    (v("volume", True), "volume is no whole number"),
    (v("volume", 1.5), "volume is no whole number"),
    (v("volume", "x"), "volume is no whole number"),
    (v("volume", "-4"), "volume is negative"),
    (v("volume", -4), "volume is negative"),
    (v("low", "98.0000000000000000001"), "prices have more digits than are stored"),
    # The duplicate at position 1 comes before the bad price at the same position.
    (edited(v("datetime", "2024-12-31"), "values", 1, "open", to="x"), "trading date comes twice"),
    (v("volume", 12), None),
    (v("volume", " 12 "), None),
    (edited(PRICES, "extra", to=[1]), None),
]


def test_price_rejections(spark):
    cases = [("aapl", p) for p, _ in PRICE_REJECTIONS]
    assert reasons(spark, P.parse_prices, S.PRICES, cases) == [r for _, r in PRICE_REJECTIONS]


def test_blank_expected_symbol(spark):
    assert reasons(spark, P.parse_prices, S.PRICES, [(" ", PRICES)]) == ["symbol asked for is blank"]


FILINGS = {
    "cik": "320193",
    "name": " Apple Inc. ",
    "filings": {
        "recent": {
            "accessionNumber": ["0000320193-25-000001", "0000320193-25-000002"],
            "filingDate": ["2025-02-01", "2025-02-02"],
            "reportDate": ["2024-12-31", ""],
            "acceptanceDateTime": ["2025-02-01T16:30:00.000Z", "2025-02-02T16:30:00-05:00"],
            "act": ["34", " "],
            "form": ["10-K", "8-K"],
            "fileNumber": ["001-1", ""],
            "filmNumber": ["", ""],
            "items": ["", "2.02"],
            "size": [10, 0],
            "isXBRL": [1, 0],
            "isInlineXBRL": [1, 0],
            "primaryDocument": ["a.htm", ""],
            "primaryDocDescription": ["10-K", ""],
        }
    },
}


def test_submission_rows(spark):
    verdicts = P.parse_submissions(land(spark, S.SUBMISSIONS, [("0000320193", FILINGS)]))
    rows = P.accepted_rows(verdicts, S.CONTRACTS["sec_submissions"]).orderBy("source_row_number")
    S.require_schema(rows, S.SUBMISSIONS_SCHEMA)
    a, b = rows.collect()
    assert (a.cik, a.company_name, a.accession_number) == ("0000320193", "Apple Inc.", "0000320193-25-000001")
    assert (a.report_date, b.report_date) == (date(2024, 12, 31), None)
    assert (a.act, b.act, b.items) == ("34", None, "2.02")
    assert (a.is_xbrl, b.is_inline_xbrl, b.size) == (True, False, 0)
    instants = rows.selectExpr("unix_timestamp(acceptance_datetime) t").collect()
    assert [r.t for r in instants] == [
        int(datetime(2025, 2, 1, 16, 30, tzinfo=timezone.utc).timestamp()),
        int(datetime(2025, 2, 2, 21, 30, tzinfo=timezone.utc).timestamp()),
    ]


def f(field, index, to):
    return edited(FILINGS, "filings", "recent", field, index, to=to)


FILING_REJECTIONS = [
    ("null", "not exactly one strict JSON object"),
    (edited(FILINGS, "cik", to="x1"), "payload.cik is invalid"),
    (edited(FILINGS, "cik", to=True), "payload.cik is invalid"),
    (edited(FILINGS, "cik", to=789019), "registrant is not the one asked for"),
    (edited(FILINGS, "cik", to=320193), None),
    (edited(FILINGS, "name", to=""), "name is blank"),
    (edited(FILINGS, "filings", to=[]), "filings has to be an object"),
    (edited(FILINGS, "filings", "recent", to=[]), "filings.recent has to be an object"),
    (edited(FILINGS, "filings", "recent", "items", drop=True), "filings.recent.items has to be a list"),
    (edited(FILINGS, "filings", "recent", "items", to=["a"]), "filings.recent has lists of different lengths"),
    (f("accessionNumber", 0, "320193-25-1"), "accessionNumber is no accession number"),
    (f("accessionNumber", 1, "0000320193-25-000001"), "accessionNumber comes twice"),
    (f("filingDate", 0, "2025-13-01"), "filingDate is no calendar date"),
    (f("reportDate", 0, "x"), "reportDate is neither empty nor a calendar date"),
    (f("reportDate", 0, None), "reportDate is neither empty nor a calendar date"),
    (f("acceptanceDateTime", 0, 5), "acceptanceDateTime has to be text"),
    (f("acceptanceDateTime", 0, "2025-02-01T16:30:00"), "acceptanceDateTime lacks an offset"),
    (f("acceptanceDateTime", 0, "2025-02-31T16:30:00Z"), "acceptanceDateTime is no instant"),
    (f("acceptanceDateTime", 0, " "), None),
    (f("form", 0, " "), "form is blank"),
    (f("act", 0, None), "act has to be text"),
    (f("size", 0, -1), "size has to be a whole number, zero or more"),
    (f("size", 0, True), "size has to be a whole number, zero or more"),
    (f("isXBRL", 0, 2), "isXBRL is neither 0 nor 1"),
    (f("isInlineXBRL", 0, False), "isInlineXBRL is neither 0 nor 1"),
    (f("primaryDocument", 0, 3), "primaryDocument has to be text"),
]


def test_filing_rejections(spark):
    cases = [("320193", p) for p, _ in FILING_REJECTIONS]
    assert reasons(spark, P.parse_submissions, S.SUBMISSIONS, cases) == [r for _, r in FILING_REJECTIONS]


def fact(**change):
    base = {
        "start": "2024-01-01", "end": "2024-12-31", "val": 120, "accn": "0000320193-25-000001",
        "fy": 2024, "fp": "FY", "form": " 10-K ", "filed": "2025-02-01", "frame": "CY2024",
    }
    base.update(change)
    return {k: x for k, x in base.items() if x != "drop"}


def facts(*occurrences, **concept):
    body = {"label": " Assets ", "description": " d ", "units": {"USD": list(occurrences)}, **concept}
    return {"cik": 320193, "entityName": " Apple Inc. ", "facts": {"us-gaap": {"Assets": {k: x for k, x in body.items() if x != "drop"}}}}


def test_company_facts_rows_keep_provider_order(spark):
    payload = {
        "cik": 320193,
        "entityName": "Apple Inc.",
        "facts": {
            "zz": {
                "B": {"label": None, "description": "  ", "units": {"shares": [fact(val=1.5), fact(start="drop", val=0.1, frame="drop", fy=None, fp=None)], "USD": []}},
                "A": {"label": "", "description": " kept ", "units": {"USD": [fact(val=123456789012345678901234567)]}},
            },
            "aa": {},
            "us-gaap": {"C": {"label": "c", "description": None, "units": {"USD": [fact(val=0.0123456789), fact(val=-1e20)]}}},
        },
    }
    verdicts = P.parse_company_facts(land(spark, S.COMPANY_FACTS, [("320193", payload), ("1", {"cik": 1, "entityName": "e", "facts": {}})]))
    rows = P.accepted_rows(verdicts, S.CONTRACTS["sec_company_facts"]).orderBy("source_row_number")
    S.require_schema(rows, S.COMPANY_FACTS_SCHEMA)
    got = rows.collect()
    assert [(r.source_row_number, r.taxonomy, r.concept, r.unit) for r in got] == [
        (0, "zz", "B", "shares"), (1, "zz", "B", "shares"), (2, "zz", "A", "USD"), (3, "us-gaap", "C", "USD"), (4, "us-gaap", "C", "USD"),
    ]
    assert (got[0].label, got[0].description, got[2].label, got[2].description) == (None, None, None, " kept ")
    assert (got[0].form, got[1].start_date, got[1].frame, got[1].fiscal_year) == ("10-K", None, None, None)
    assert [r.value for r in got] == [
        Decimal("1.5"), Decimal("0.1"), Decimal("123456789012345678901234567"), Decimal("0.0123456789"), Decimal("-100000000000000000000"),
    ]
    assert {r.value_exact for r in got} == {True}
    assert {r.entity: r.record_count for r in P.accepted_counts(verdicts).collect()} == {"320193": 5, "1": 0}


FACT_REJECTIONS = [
    (facts(fact(val=0.12345678901234567)), "val has more digits than are stored"),
    (facts(fact(val=10**29)), "val has more digits than are stored"),
    ("[{}]", "not exactly one strict JSON object"),
    (json.dumps(facts()) + "}", "not exactly one strict JSON object"),
    (json.dumps(facts()) + "]", "not exactly one strict JSON object"),
    (json.dumps(facts()) + ",{}", "not exactly one strict JSON object"),
    ("\n" + json.dumps(facts(fact())) + "\n", None),
    ('{"cik": NaN}', "not exactly one strict JSON object"),
    (facts() | {"cik": 5}, "registrant is not the one asked for"),
    (facts() | {"entityName": " "}, "entityName is blank"),
    (facts() | {"facts": []}, "facts is not nested by taxonomy, concept and unit"),
    (facts() | {"facts": {" ": {}}}, "taxonomy is blank"),
    (facts() | {"facts": {"t": {"": {"label": "x", "description": "", "units": {}}}}}, "concept is blank"),
    (facts() | {"facts": {"t": 4}}, "facts is not nested by taxonomy, concept and unit"),
    (facts(label="drop"), "label has to be text or null"),
    (facts(label=4), "label has to be text or null"),
    (facts(description="drop"), "description has to be text or null"),
    (facts(units="drop"), "units has to be an object"),
    (facts(units={" ": []}), "unit is blank"),
    (facts(4), "fact occurrence has to be an object"),
    (facts(fact(start=None)), "start is no calendar date"),
    (facts(fact(end="2024-12-32")), "end is no calendar date"),
    (facts(fact(start="2025-01-01")), "start lies after end"),
    (facts(fact(form="")), "form is blank"),
    (facts(fact(val="12")), "val is no finite number"),
    (facts(fact(val=True)), "val is no finite number"),
    (facts(fact(val=None)), "val is no finite number"),
    (facts(fact(accn="1-2-3")), "accn is no accession number"),
    (facts(fact(fy=0)), "fy has to be a whole number above zero"),
    (facts(fact(fy="2024")), "fy has to be a whole number above zero"),
    (facts(fact(fp=4)), "fp has to be text"),
    (facts(fact(filed="")), "filed is no calendar date"),
    (facts(fact(frame=1)), "frame has to be text"),
    (facts(fact(), fact(fp=4), fact(form="")), "fp has to be text"),
    (facts(fact(fy="drop", fp="drop", frame="drop", start="drop")), None),
    (facts(fact(), fact()), None),
]


def test_fact_rejections(spark):
    cases = [("0000320193", p) for p, _ in FACT_REJECTIONS]
    assert reasons(spark, P.parse_company_facts, S.COMPANY_FACTS, cases) == [r for _, r in FACT_REJECTIONS]


SERIES = {
    "seriess": [
        {
            "id": " DFF ", "realtime_start": "2025-01-01", "realtime_end": "2025-01-01", "title": "Rate",
            "observation_start": "1954-07-01", "observation_end": "2025-01-01", "frequency": "Daily",
            "frequency_short": "D", "units": "Percent", "units_short": "%", "seasonal_adjustment": "Not",
            "seasonal_adjustment_short": "NSA", "last_updated": "2025-01-02 15:17:01-06", "popularity": 80, "notes": " n ",
        }
    ]
}


def test_series_metadata_row(spark):
    verdicts = P.parse_series_metadata(land(spark, S.SERIES_METADATA, [("DFF", SERIES)]))
    rows = P.accepted_rows(verdicts, S.CONTRACTS["fred_series_metadata"])
    S.require_schema(rows, S.SERIES_METADATA_SCHEMA)
    row = rows.selectExpr("*", "unix_timestamp(last_updated) t").collect()[0]
    assert (row.series_id, row.title, row.popularity, row.notes) == ("DFF", "Rate", 80, "n")
    assert row.t == int(datetime(2025, 1, 2, 21, 17, 1, tzinfo=timezone.utc).timestamp())


def s(field, to):
    return edited(SERIES, "seriess", 0, field, to=to)


SERIES_REJECTIONS = [
    (edited(SERIES, "seriess", to=3), "seriess has to be a list"),
    (edited(SERIES, "seriess", to=[]), "seriess holds none or several series"),
    (edited(SERIES, "seriess", to=[1]), "series item has to be an object"),
    (s("id", ""), "id has to be text that is not blank"),
    (s("id", "GDP"), "series is not the one asked for"),
    (s("realtime_start", "2025-1-1"), "realtime_start is no calendar date"),
    (s("realtime_end", "2024-01-01"), "realtime_start lies after realtime_end"),
    (s("observation_end", "1950-01-01"), "observation_start lies after observation_end"),
    (s("units", " "), "units has to be text that is not blank"),
    (s("last_updated", "2025-01-02 15:17:01"), "last_updated lacks an offset"),
    (s("last_updated", "yesterdayZ"), "last_updated is no instant"),
    (s("popularity", "80"), "popularity has to be a whole number, zero or more"),
    (s("popularity", -1), "popularity has to be a whole number, zero or more"),
    (s("notes", 4), "notes has to be text or null"),
    (s("notes", None), None),
]


def test_series_rejections(spark):
    cases = [("DFF", p) for p, _ in SERIES_REJECTIONS]
    assert reasons(spark, P.parse_series_metadata, S.SERIES_METADATA, cases) == [r for _, r in SERIES_REJECTIONS]


def obs(day="2024-12-01", value="4.50", start="2025-01-01", end="2025-01-01"):
    return {"realtime_start": start, "realtime_end": end, "date": day, "value": value}


def test_observation_rows(spark):
    ten = "0.12345678900000"
    payload = {"observations": [obs(), obs("2024-12-02", "."), obs("2024-12-02", "1", end="2025-02-01"), obs("2024-12-03", ten)]}
    verdicts = P.parse_observations(land(spark, S.SERIES_OBSERVATIONS, [("DFF", payload), ("GDP", {"observations": []})]))
    rows = P.accepted_rows(verdicts, S.CONTRACTS["fred_series_observations"]).orderBy("source_row_number")
    S.require_schema(rows, S.SERIES_OBSERVATIONS_SCHEMA)
    got = rows.collect()
    assert [r.value for r in got] == [Decimal("4.5"), None, Decimal(1), Decimal("0.1234567890")]
    assert {r.value_exact for r in got} == {True}
    assert [r.value_text for r in got] == ["4.50", None, "1", ten]


OBSERVATION_REJECTIONS = [
    ({"observations": {}}, "observations has to be a list"),
    ({"observations": [3]}, "observation item has to be an object"),
    ({"observations": [obs(start="2025-02-30")]}, "realtime_start is no calendar date"),
    ({"observations": [obs(end="")]}, "realtime_end is no calendar date"),
    ({"observations": [obs(end="2024-01-01")]}, "realtime_start lies after realtime_end"),
    ({"observations": [obs(day=None)]}, "date is no calendar date"),
    ({"observations": [obs(value=4.5)]}, "value has to be text"),
    ({"observations": [obs(value=" ")]}, "value is blank"),
    ({"observations": [obs(value="n/a")]}, "value is no finite decimal"),
    ({"observations": [obs(value="Infinity")]}, "value is no finite decimal"),
    ({"observations": [obs(value="0.123456789012345678901234567890")]}, "value has more digits than are stored"),
    ({"observations": [obs(value="1" * 40)]}, "value has more digits than are stored"),
    ({"observations": [obs(), obs("2024-12-02"), obs(value="5")]}, "observation comes twice"),
    ({"observations": [obs(), obs(), obs(value="x")]}, "observation comes twice"),
    ({"observations": [obs(), obs(value="x"), obs("2024-12-02")]}, "value is no finite decimal"),
]


def test_observation_rejections(spark):
    cases = [("DFF", p) for p, _ in OBSERVATION_REJECTIONS]
    got = reasons(spark, P.parse_observations, S.SERIES_OBSERVATIONS, cases)
    assert got == [r for _, r in OBSERVATION_REJECTIONS]


def test_quarantine_and_dispatch(spark):
    landing = land(spark, S.PRICES, [("AAPL", PRICES), ("AAPL", "{")])
    verdicts = P.parse(landing, "market_daily_prices")
    assert [(r.entity, r.reason) for r in P.quarantined(verdicts).collect()] == [("AAPL", "not exactly one strict JSON object")]
    assert P.accepted_rows(verdicts, S.CONTRACTS["market_daily_prices"]).count() == 2
    assert P.parse(landing, "sec_submissions").count() == 0


@pytest.mark.parametrize("table", list(P.PARSERS))
def test_parsing_never_shuffles(spark, table, capsys):
    landing = land(spark, S.CONTRACTS[table].identity, [("x", "{}")])
    plan = P.accepted_rows(P.parse(landing, table), S.CONTRACTS[table])
    plan.explain()
    text = capsys.readouterr().out
    assert "Exchange" not in text and "Python" not in text
