"""Edge rows of the ordered, incremental, quality, monitoring and measure operators."""

from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import numeric, temporal, text
from tidemark.operators import incremental, measures, monitoring, quality, recovery, timeseries, versions
from tidemark.plans import dimensions, marts, reference_data

D = date


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).head()[0]


# --- functions ------------------------------------------------------------------

@pytest.mark.parametrize("value,expected", [
    ("2024-02-29", D(2024, 2, 29)), ("2023-02-29", None), ("2024-1-5", None), (" 2024-01-05", None), ("2024-01-05\n", None), (None, None),
])
def test_strict_date(spark, value, expected):
    assert one(spark, temporal.strict_date(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize("value,seconds", [
    ("1970-01-01T00:00:10Z", 10), ("1970-01-01 02:00:00+02:00", 0), ("1970-01-01T00:00:00-0130", 5400),
    ("1970-01-01T01:00+01", 0), ("1970-01-01T00:00:00", None), ("1970-01-01", None), ("1970-02-30T00:00:00Z", None),
    ("1970-01-01T00:00:01.500Z", 1), ("1970-01-01T00:00:01,5+00:00", 1),
])
def test_strict_instant(spark, value, seconds):
    assert one(spark, F.unix_timestamp(temporal.strict_instant(F.lit(value)))) == seconds


@pytest.mark.parametrize("value,digits,fits", [
    ("1", 0, True), ("1.50", 1, True), ("100E-2", 0, True), ("1e-11", 11, False), ("0.00000000000000", 0, True),
    ("-12.12345678901", 11, False), ("12345E-3", 3, True), (" 7.1 ", 1, True), (".5", 1, True), ("5.", 0, True),
])
def test_fraction_digits(spark, value, digits, fits):
    assert one(spark, numeric.fraction_digits(F.lit(value))) == digits
    assert one(spark, numeric.fits_exactly(F.lit(value), 38, 10)) is fits


@pytest.mark.parametrize("value", ["NaN", "Infinity", "1,000", "", "0x1", "1e", None])
def test_not_a_decimal(spark, value):
    assert one(spark, numeric.to_decimal(F.lit(value).cast("string"), 38, 10)) is None
    assert one(spark, numeric.fits_exactly(F.lit(value).cast("string"), 38, 10)) is not True


def test_decimal_overflow_is_null(spark):
    assert one(spark, numeric.to_decimal(F.lit("1e30"), 38, 10)) is None


@pytest.mark.parametrize("value,expected", [
    ("1", "0000000001"), ("0000320193", "0000320193"), ("0", None), ("000", None), ("12345678901", None), ("1a", None), ("", None), (" 1", None),
])
def test_cik(spark, value, expected):
    assert one(spark, text.cik10(F.lit(value))) == expected


@pytest.mark.parametrize("entity", ["AAPL", "a?b>c~", "ünïcode €", "x" * 200])
def test_run_id_round_trip(spark, entity):
    at = datetime(2025, 3, 1, 22, 30, 0, 125, tzinfo=timezone.utc)
    row = spark.createDataFrame([(at, entity)], "at timestamp, e string").select(text.run_id(F.col("at"), F.col("e")).alias("r"))
    row = row.select("r", text.run_entity(F.col("r")).alias("e"), F.unix_micros(text.run_instant(F.col("r"))).alias("t"), F.col("r").rlike(S.RUN_ID_PATTERN).alias("ok")).head()
    assert row.r.startswith("20250301T223000000125Z--entity-") and row.ok
    assert (row.e, row.t) == (entity, int(at.timestamp()) * 1_000_000 + 125)


@pytest.mark.parametrize("name,label", [
    ("Equity Attributable to Parent", "Equity"), ("REVENUE FROM CONTRACTS WITH CUSTOMERS x", "Revenue"), ("Other", "Other"), ("Total Assets", "Total Assets"),
])
def test_metric_short_name(spark, name, label):
    assert one(spark, text.metric_short_name(F.lit(name))) == label


# --- ordered operators ----------------------------------------------------------

OBSERVED = [("A", D(2024, 1, 5), 1.0), ("A", D(2024, 1, 10), None), ("A", D(2024, 2, 1), 3.0), ("B", D(2023, 12, 1), 9.0)]


def series(spark):
    return spark.createDataFrame(OBSERVED, "series_id string, observation_date date, value double")


DAYS = [D(2024, 1, 4), D(2024, 1, 5), D(2024, 1, 9), D(2024, 1, 10), D(2024, 1, 31), D(2024, 2, 5)]
EXPECTED = {
    ("A", D(2024, 1, 4)): (None, None),
    ("A", D(2024, 1, 5)): (D(2024, 1, 5), 1.0),
    ("A", D(2024, 1, 9)): (D(2024, 1, 5), 1.0),
    # The latest observation wins although its value is NULL.
    ("A", D(2024, 1, 10)): (D(2024, 1, 10), None),
    ("A", D(2024, 1, 31)): (D(2024, 1, 10), None),
    ("A", D(2024, 2, 5)): (D(2024, 2, 1), 3.0),
    **{("B", d): (D(2023, 12, 1), 9.0) for d in DAYS},
}


def test_asof_join(spark):
    left = spark.createDataFrame([(s, d) for s in "AB" for d in DAYS] + [("C", D(2024, 1, 5))], "series_id string, day date")
    got = timeseries.asof_join(left, series(spark), by=["series_id"], left_on="day", right_on="observation_date", take={"at": "observation_date", "v": "value"})
    assert {(r.series_id, r.day): (r.at, r.v) for r in got.collect()} == {**EXPECTED, ("C", D(2024, 1, 5)): (None, None)}


def test_filled_forward_agrees_with_asof_join(spark):
    bounds = spark.createDataFrame([(DAYS[0], DAYS[-1])], "first_day date, last_day date")
    got = timeseries.filled_forward(series(spark), bounds, by=["series_id"], on="observation_date", day="day", take={"at": "observation_date", "v": "value"})
    rows = {(r.series_id, r.day): (r.at, r.v) for r in got.collect()}
    assert len(rows) == 2 * ((DAYS[-1] - DAYS[0]).days + 1)
    assert {k: rows[k] for k in EXPECTED} == EXPECTED


def test_filled_forward_before_and_after_the_window(spark):
    """A series entirely after the window still covers it, with NULLs."""
    late = spark.createDataFrame([("L", D(2030, 1, 1), 1.0)], "series_id string, observation_date date, value double")
    bounds = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 3))], "first_day date, last_day date")
    got = timeseries.filled_forward(late, bounds, by=["series_id"], on="observation_date", day="day", take={"at": "observation_date"})
    assert [(r.day, r["at"]) for r in got.orderBy("day").collect()] == [(D(2024, 1, d), None) for d in (1, 2, 3)]


def test_calendar_of_nothing_is_empty(spark):
    nothing = spark.createDataFrame([], "d date")
    assert timeseries.calendar(timeseries.day_bounds(nothing, "d")).count() == 0


def test_calendar_attributes(spark):
    bounds = spark.createDataFrame([(D(2024, 2, 28), D(2024, 3, 3))], "first_day date, last_day date")
    rows = timeseries.calendar(bounds).orderBy("date_day").collect()
    assert [r.date_day.day for r in rows] == [28, 29, 1, 2, 3]
    assert [(r.day_of_week, r.is_weekend) for r in rows] == [(3, False), (4, False), (5, False), (6, True), (7, True)]


def test_latest_version_with_null_keys(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(None, "k", at, "r1", at, 0, "old"), (None, "k", at, "r2", at, 0, "new"), ("s", "k", at, "r1", at, 0, "other")]
    df = spark.createDataFrame(rows, "start string, k string, ingested_at timestamp, run_id string, loaded_at timestamp, source_row_number long, v string")
    assert sorted(r.v for r in versions.latest_version(df, ["start", "k"]).collect()) == ["new", "other"]


def test_hot_key_in_versions_and_alignment(spark):
    """A third of the rows are versions of one key, another third fall on one day."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("symbol"),
        F.when(F.col("id") % 3 < 2, F.lit(D(2024, 1, 5))).otherwise(F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 40).cast("int"))).alias("day"),
        F.timestamp_seconds(F.col("id") % 7919).alias("ingested_at"),
        F.col("id").cast("string").alias("run_id"),
        F.timestamp_seconds(F.lit(0)).alias("loaded_at"),
        F.col("id").alias("source_row_number"),
    )
    latest = versions.latest_version(rows, ["symbol", "day"])
    best = rows.groupBy("symbol", "day").agg(F.max(F.struct("ingested_at", "run_id", "loaded_at", "source_row_number")).alias("b"))
    wrong = latest.join(best, ["symbol", "day"], "full_outer").where(~F.col("source_row_number").eqNullSafe(F.col("b.source_row_number")))
    assert wrong.count() == 0 and latest.count() == best.count()
    probes = rows.select(F.lit("A").alias("series_id"), "day", "source_row_number")
    aligned = timeseries.asof_join(probes, series(spark), by=["series_id"], left_on="day", right_on="observation_date", take={"v": "value"})
    assert aligned.count() == 30_000
    assert aligned.where(F.col("day") == F.lit(D(2024, 1, 5))).select("v").distinct().collect()[0].v == 1.0


# --- marts ----------------------------------------------------------------------

def growth(spark, facts, identities=None):
    schema = (
        "cik string, metric_key string, taxonomy string, concept string, unit string, value decimal(38,10), start_date date, end_date date, "
        "accession_number string, fiscal_year int, fiscal_period string, form string, filed_date date, frame string"
    )
    rows = []
    for f in facts:
        base = dict(
            cik="0000320193", metric_key="total_assets", taxonomy="us-gaap", concept="Assets", unit="USD", start_date=None,
            accession_number="a", fiscal_year=2000, fiscal_period="FY", form="10-K", filed_date=D(2001, 1, 1), frame=None,
        )
        base.update(f)
        base["value"] = Decimal(base["value"])
        rows.append(tuple(base[c.split()[0]] for c in schema.split(", ")))
    frame = spark.createDataFrame(rows, schema)
    metrics = dimensions.dim_financial_metric(reference_data.financial_metrics(spark))
    mart = marts.mart_company_financial_growth(frame, identities or reference_data.company_identities(spark), metrics)
    return mart.orderBy("company_key", "unit", "end_date").collect()


@pytest.mark.parametrize("gap,comparable", [(349, False), (350, True), (380, True), (381, False)])
def test_annual_gap(spark, gap, comparable):
    first = D(2020, 12, 31)
    rows = growth(spark, [dict(value=-50, end_date=first), dict(value=25, end_date=D.fromordinal(first.toordinal() + gap))])
    assert rows[1].previous_value == -50 and rows[1].previous_end_date == first
    assert (rows[1].absolute_change, rows[1].growth_rate) == ((75, 1.5) if comparable else (None, None))


def test_growth_from_zero(spark):
    rows = growth(spark, [dict(value=0, end_date=D(2020, 12, 31)), dict(value=5, end_date=D(2021, 12, 31))])
    assert (rows[1].absolute_change, rows[1].growth_rate) == (5, None)


def test_amended_filing_represents_the_year(spark):
    end = D(2020, 12, 31)
    rows = growth(spark, [
        dict(value=1, end_date=end, filed_date=D(2021, 2, 1), accession_number="9"),
        dict(value=2, end_date=end, filed_date=D(2021, 3, 1), accession_number="1", form="10-K/A"),
        dict(value=3, end_date=end, filed_date=D(2021, 3, 1), accession_number="0"),
        dict(value=4, end_date=end, filed_date=D(2022, 3, 1), form="10-Q"),
        dict(value=5, end_date=end, filed_date=D(2022, 3, 1), fiscal_period="Q4"),
        dict(value=6, end_date=end, filed_date=D(2022, 3, 1), start_date=D(2020, 1, 1)),
        dict(value=7, end_date=end, filed_date=D(2022, 3, 1), cik="0000000001"),
    ])
    assert [r.current_value for r in rows] == [2]


def test_predecessor_and_successor_share_a_series(spark):
    rows = growth(spark, [
        dict(value=10, end_date=D(2024, 12, 31), cik="0000034088"), dict(value=11, end_date=D(2025, 12, 31), cik="0002115436"),
    ])
    assert [(r.company_key, r.source_cik, r.previous_value) for r in rows] == [("XOM", "0000034088", None), ("XOM", "0002115436", 10)]


def test_zero_previous_close(spark):
    schema = "symbol string, trading_date date, open decimal(38,18), high decimal(38,18), low decimal(38,18), close decimal(38,18), volume long"
    rows = [("AAPL", D(2024, 1, d), *[Decimal(c)] * 4, 1) for d, c in ((2, 0), (3, "1.000000000000000001"))]
    companies = spark.createDataFrame([("0000320193", "Apple")], "cik string, entity_name string")
    mart = marts.mart_company_daily_performance(spark.createDataFrame(rows, schema), reference_data.company_identities(spark), companies)
    last = mart.orderBy("trading_date").collect()[1]
    assert (last.daily_change, last.daily_return) == (Decimal("1.000000000000000001"), None)


def test_only_the_current_registrant_trades(spark):
    schema = "symbol string, trading_date date, open decimal(38,18), high decimal(38,18), low decimal(38,18), close decimal(38,18), volume long"
    prices = spark.createDataFrame([("XOM", D(2024, 1, 2), *[Decimal(5)] * 4, 1)], schema)
    companies = spark.createDataFrame([("0000034088", "Old"), ("0002115436", "New")], "cik string, entity_name string")
    rows = marts.mart_company_daily_performance(prices, reference_data.company_identities(spark), companies).collect()
    assert [(r.current_cik, r.company_name) for r in rows] == [("0002115436", "New")]


# --- incremental ----------------------------------------------------------------

def test_refresh_plan_modes(spark):
    entities = spark.createDataFrame([("A",), ("B",)], "symbol string")
    marks = spark.createDataFrame([("A", D(2024, 3, 2))], "symbol string, watermark date")
    plan = {r.symbol: r for r in incremental.refresh_plan(entities, marks, "symbol", overlap_days=3).collect()}
    assert (plan["A"].mode, plan["A"].start_date) == ("incremental", D(2024, 2, 28))
    assert (plan["B"].mode, plan["B"].start_date) == ("full", None)
    explicit = incremental.refresh_plan(entities, marks, "symbol", overlap_days=3, start=D(2020, 1, 1), end=D(2020, 2, 1)).collect()
    assert {(r.mode, r.start_date, r.end_date) for r in explicit} == {("explicit", D(2020, 1, 1), D(2020, 2, 1))}


@pytest.mark.parametrize("bad", [-1, True, 1.5])
def test_overlap_must_be_a_count(spark, bad):
    with pytest.raises(ValueError):
        incremental.lower_bound(F.lit("x"), bad)


def test_ranges(spark):
    for start, end in ((D(2020, 1, 1), None), (None, D(2020, 1, 1)), (D(2020, 1, 2), D(2020, 1, 1))):
        with pytest.raises(ValueError):
            incremental.paired_range(start, end)
    incremental.paired_range(None, None)
    with pytest.raises(ValueError):
        incremental.refresh_plan(None, None, "s", overlap_days=1, start=D(2020, 1, 2), end=D(2020, 1, 1))


def test_entity_plan_reports_blank_and_repeated_keys(spark):
    df = spark.createDataFrame([(0, " aapl"), (1, "AAPL "), (2, "\t"), (3, "msft")], "position int, symbol string")
    rows = {r.symbol: (r.position, r.problem) for r in incremental.entity_plan(df, "symbol").collect()}
    assert rows == {"AAPL": (0, "duplicate key"), "": (2, "key must not be blank"), "MSFT": (3, None)}


def test_upsert(spark):
    schema = "k int, v decimal(10,2), w long"
    current = spark.createDataFrame([(1, Decimal(1), None), (2, Decimal(2), 5), (3, Decimal(3), 6)], schema)
    incoming = spark.createDataFrame([(1, Decimal(1), None), (2, Decimal(2), None), (4, Decimal(4), 7)], schema)
    merged = incremental.upsert(current, incoming, ["k"])
    assert {(r.k, r.w, r.action) for r in merged.collect()} == {(1, None, "unchanged"), (2, None, "updated"), (3, 6, "kept"), (4, 7, "inserted")}
    assert incremental.upsert_counts(merged).head().asDict() == {"inserted": 1, "updated": 1, "unchanged": 1, "total": 4}
    with pytest.raises(incremental.DuplicateKeys):
        incremental.upsert(current, incoming.unionByName(incoming), ["k"])


# --- recovery -------------------------------------------------------------------

def test_unequal_runs(spark):
    schema = "source string, dataset string, run_id string, source_row_number long, v int"
    good = [("s", "d", "r", i, i) for i in range(3)]
    expected = spark.createDataFrame(good, schema)

    def bad(rows):
        return [r.different_rows for r in recovery.unequal_runs(expected, spark.createDataFrame(rows, schema)).collect()]

    assert bad(good) == []
    assert bad(good[:2]) == [1]
    assert bad(good + [("s", "d", "r", 3, 3)]) == [1]
    assert bad(good[:2] + [("s", "d", "r", 2, None)]) == [1]
    assert bad(good + good[:1]) == [1]


RUN_ROWS = "source string, dataset string, run_id string, source_row_number long, v int, w string"


def _runs_of_rows(spark, changed):
    """Three runs of three rows, and the same with some rows of the second one changed."""
    rows = [("s", "d", f"r{k}", i, 10 * k + i, None if i else "x") for k in range(3) for i in range(3)]
    return spark.createDataFrame(rows, RUN_ROWS), spark.createDataFrame(changed(list(rows)), RUN_ROWS)


@pytest.mark.parametrize("changed,expected", [
    (lambda rows: rows[::-1], {}),
    (lambda rows: rows[:3] + rows[4:], {"r1": 1}),
    (lambda rows: [*rows, rows[4]], {"r1": 1}),
    (lambda rows: [*rows[:4], (*rows[4][:4], 0, "y"), *rows[5:]], {"r1": 1}),
    # A NULL that moves to the next column, and rows that swap their numbers.
    (lambda rows: [*rows[:3], (*rows[3][:4], None, "x"), *rows[4:]], {"r1": 1}),
    (lambda rows: [*rows[:3], (*rows[4][:3], 0, *rows[4][4:]), (*rows[3][:3], 1, *rows[3][4:]), *rows[5:]], {"r1": 2}),
    (lambda rows: rows[:3] + rows[6:] + [("s", "d", "r9", 0, 1, "z")], {"r1": 3, "r9": 1}),
])
@pytest.mark.parametrize("collides", [False, True])
def test_fingerprints_find_what_comparing_rows_finds(spark, changed, expected, collides):
    """Also with a digest that is the same for all rows: runs that share it are compared by rows."""
    digest = (lambda columns: (F.lit(1).cast("bigint"), F.lit(1).cast("bigint"))) if collides else recovery.row_digest
    left, right = _runs_of_rows(spark, changed)
    assert {r.run_id: r.different_rows for r in recovery.unequal_runs(left, right).collect()} == expected
    assert {r.run_id: r.different_rows for r in recovery.verified_rows(left, right, digest).collect()} == expected
    suspects = {r.run_id for r in recovery.suspect_runs(left, right, digest).collect()}
    assert set(expected) <= suspects and (collides or suspects == set(expected))


def test_null_places_are_part_of_the_digest(spark):
    a, b = (spark.createDataFrame([r], "x int, y int") for r in [(None, 1), (1, None)])
    first, second = (df.select(*recovery.row_digest(["x", "y"])).head() for df in (a, b))
    assert first[0] != second[0] and first[1] != second[1]


# --- quality --------------------------------------------------------------------

def test_identity_expected_rows(spark):
    identities = reference_data.company_identities(spark)
    wanted = [("XOM", "0000034088", "predecessor", False), ("XOM", "0002115436", "successor", True)]
    assert quality.identity_violations(identities, wanted).count() == 0
    broken = identities.where("registrant_role <> 'predecessor'")
    reasons = [r.failure_reason for r in quality.identity_violations(broken, wanted).collect()]
    assert reasons == ["XOM predecessor (CIK 0000034088, role predecessor, non-current) must exist exactly once"]


def test_every_table_has_checks_that_fire(spark):
    """A row of blanks and reversed ranges breaks every check of its table."""
    import pyspark.sql.types as T

    low = {T.StringType(): " ", T.LongType(): -1, T.DateType(): D(2024, 1, 1), T.TimestampType(): datetime(2024, 1, 1), T.BooleanType(): True}
    for name in ("ingestion_runs", *S.CONTRACTS):
        schema = S.INGESTION_RUNS_SCHEMA if name == "ingestion_runs" else S.CONTRACTS[name].schema
        values = {f.name: low.get(f.dataType, Decimal(1) if isinstance(f.dataType, T.DecimalType) else 1) for f in schema.fields}
        values |= {k: v for k, v in {
            "high": Decimal(0), "low": Decimal(2), "end_date": D(2023, 1, 1), "realtime_end": D(2023, 1, 1), "observation_end": D(2023, 1, 1),
        }.items() if k in values}
        rows = spark.createDataFrame([tuple(values[f.name] for f in schema.fields)], schema)
        fired = {r.rule for r in quality.check_violations(rows, name).collect()}
        assert fired == set(quality.table_checks(name)), name


def test_null_results_pass_checks(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, -5)], "k int, v int")
    assert [r.k for r in quality.failed_checks(df, ["k"], {"v": F.col("v") >= 0}).collect()] == [3]


# --- monitoring -----------------------------------------------------------------

def runs(spark, counts):
    rows = [
        ("twelve_data", "daily_market_prices", f"2024010{i}T000000000000Z", datetime(2024, 1, i, tzinfo=timezone.utc), c)
        for i, c in enumerate(counts, 1)
    ]
    return spark.createDataFrame(rows, "source string, dataset string, run_id string, ingested_at timestamp, record_count long")


@pytest.mark.parametrize("counts,delta,percent,status", [
    ([5], None, None, "info"), ([0, 5], 5, None, "info"), ([9, 4, 5], 1, 25.0, "info"), ([4, -1], None, None, "error"), ([None, 1], None, None, "error"),
])
def test_run_count_signal(spark, counts, delta, percent, status):
    signals = monitoring.run_count_signals(runs(spark, counts), D(2024, 2, 1))
    rows = {r.dataset: r for r in signals.collect()}
    assert len(rows) == 5 and rows["submissions"].message == "No loaded ingestion runs are available for this dataset."
    mine = rows["daily_market_prices"]
    values = {m.name: m.value for m in mine.measurements}
    assert mine.status == status
    if status == "info":
        assert values["absolute_delta"] == (None if delta is None else str(delta))
        assert values["percent_delta"] == (None if percent is None else str(percent))
    else:
        assert values == {}


def test_status_roll_up(spark):
    def worst(*statuses):
        return monitoring.overall_status(spark.createDataFrame([(s,) for s in statuses], "status string")).head().status

    assert (worst("ok", "info"), worst("ok"), worst("info", "error", "ok")) == ("info", "ok", "error")


def test_relation_check(spark):
    spark.range(1).createOrReplaceTempView("known_relation")
    rows = {r.relation: r.status for r in monitoring.relation_check(spark, ["known_relation", "unknown_relation"]).collect()}
    assert rows == {"known_relation": "ok", "unknown_relation": "error"}


def test_as_of_must_be_a_date(spark):
    with pytest.raises(ValueError):
        monitoring.recency_signals(
            None, "s", "d", None, check_id="market_latest_trading_date", identity=S.PRICES, as_of="2024-01-01"
        )


# --- measures -------------------------------------------------------------------

def test_selected_value(spark):
    df = spark.createDataFrame([("one", 1), ("one", 1), ("two", 1), ("two", 2), ("mixed", 1), ("mixed", None), ("none", None)], "k string, v int")
    got = {r.k: (r.v, r.h) for r in df.groupBy("k").agg(measures.selected_value("v").alias("v"), measures.has_one("v").alias("h")).collect()}
    assert got == {"one": (1, True), "two": (None, False), "mixed": (None, False), "none": (None, True)}


def test_gate_looks_at_the_selection_not_the_group(spark):
    schema = "company_key string, series_id string, trading_date date, market_close double, macro_value double, macro_observation_date date, macro_age_days int"
    rows = [(c, "S", D(2024, 1, d), 1.0, 2.0, None, None) for c in "AB" for d in (1, 2)]
    mart = spark.createDataFrame(rows, schema)

    def closes(**request):
        out = measures.measure_query(mart, "macro", ["market_close", "market_macro_context_is_valid"], group_by=["company_key", "trading_date"], **request)
        return {(r.market_close, r.market_macro_context_is_valid) for r in out.collect()}

    assert closes() == {(None, 0)}
    assert closes(filters={"company_key": ["A"]}) == {(1.0, 1)}
    both = mart.select("company_key").distinct()
    # A date slicer does not narrow the selected companies.
    one_day = {"trading_date": measures.DayRange(D(2024, 1, 1), D(2024, 1, 1))}
    assert closes(filters=one_day, companies=both.where("company_key = 'A'")) == {(1.0, 1)}
    assert closes(filters={"company_key": ["A"]}, companies=both) == {(1.0, 1)}
    assert closes(filters=one_day, companies=both) == {(None, 0)}


def test_period_return_needs_two_days_and_a_base(spark):
    schema = "company_key string, trading_date date, close double, daily_return double, volume long, previous_close double, daily_change double"
    rows = [("A", D(2024, 1, 1), 4.0, None, 1, None, None), ("B", D(2024, 1, 1), 0.0, None, 1, None, None),
            ("B", D(2024, 1, 2), 4.0, None, 1, None, None), ("C", D(2024, 1, 1), 4.0, None, 1, None, None), ("C", D(2024, 1, 2), 5.0, None, 1, None, None)]
    out = measures.measure_query(spark.createDataFrame(rows, schema), "market", ["selected_period_return"], group_by=["company_key"])
    assert {r.company_key: r.selected_period_return for r in out.collect()} == {"A": None, "B": None, "C": 0.25}


def test_star_rejects_unknown_role(spark):
    with pytest.raises(ValueError):
        measures.star(None, "growth", None, None, date_role="start_date")


def test_reports_come_in_order(spark):
    """Days ascend; companies descend by their measure, then by key."""
    from workload import QUERIES

    days = [r.trading_date for r in QUERIES["close_per_day"](spark, "/root/testdata/sf0.001").collect()]
    assert len(days) > 10 and days == sorted(days)
    ranked = QUERIES["company_ranking"](spark, "/root/testdata/sf0.001").collect()
    names = ranked[0].__fields__
    number = next(n for n in names if isinstance(ranked[0][n], float))
    values = [r[number] for r in ranked if r[number] is not None]
    assert len(values) > 2 and values in (sorted(values), sorted(values, reverse=True))
