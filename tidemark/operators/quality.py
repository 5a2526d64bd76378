"""Data-quality rules.  Every check is a query whose rows are the violations.

Rules of one table share a single pass: conditions become an array of reasons that is
filtered and exploded, NULL counts are one aggregation.  Checks that compare a mart
with its sources use aggregates and equi-joins, never pairs of rows within a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import exact_difference, growth_rate, simple_return
from tidemark.functions.temporal import days_between, has_annual_shape, is_annual_gap
from tidemark.functions.text import is_not_blank
from tidemark.operators.relational import differs, literal_table, measured, set_difference
from tidemark.operators.timeseries import day_bounds, filled_forward, with_previous
from tidemark.plans.marts import ANNUAL_FORMS, annual_candidates
from tidemark.schemas import CONTRACTS, GROWTH_GRAIN, IDENTITY_MAPPING_SCHEMA, RUN_ID_PATTERN, RUN_KEY

TOLERANCE = 0.000001


# --- generic rules --------------------------------------------------------------

def violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column], reason: str = "failure_reason") -> DataFrame:
    """Key and reason of every broken rule.  A rule that evaluates to NULL is not broken."""
    broken = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules.items()]))
    return df.select(*keys, F.explode(broken).alias(reason))


def failed_checks(df: DataFrame, keys: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """Rows failing a CHECK-style condition; like in SQL, an unknown result passes."""
    return violations(df, keys, {name: ~condition for name, condition in checks.items()}, "rule")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Required columns that hold NULLs, with their counts, in one aggregation."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in columns])
    return counted.select(F.inline(pairs)).where("null_count > 0")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once.  NULLs compare equal."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Values outside the accepted list, with their row counts; NULL is accepted."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
    )


def orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]) -> DataFrame:
    """Child keys without a parent, with their row counts.

    The child is reduced to its distinct keys first, so a key with very many rows
    reaches the anti join once.  Keys with a NULL part are not checked.
    """
    present = child.dropna(subset=list(child_keys)).groupBy(*child_keys).agg(F.count("*").alias("row_count"))
    renamed = parent.select(*[F.col(p).alias(c) for c, p in zip(child_keys, parent_keys, strict=True)])
    return present.join(renamed, list(child_keys), "left_anti")


def uncovered_days(df: DataFrame, column: str, days: DataFrame) -> DataFrame:
    """Dates of a column that the calendar does not have."""
    dates = df.where(F.col(column).isNotNull()).select(F.col(column).alias("date_day"))
    return set_difference(dates, days, ["date_day"])


def calendar_gaps(days: DataFrame) -> DataFrame:
    """Days whose next day is missing, the last day aside.

    An anti join against the next day takes the place of an ordered window over the
    whole calendar.
    """
    last = days.agg(F.max("date_day")).scalar()
    following = days.select(F.date_sub("date_day", 1).alias("date_day"))
    return days.select("date_day").where(F.col("date_day") < last).join(following, "date_day", "left_anti")


def multivalued(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Keys with more than one distinct value of a column."""
    return (
        df.groupBy(*keys)
        .agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
        .where("_low <> _high")
        .select(*keys)
    )


# --- seeds ----------------------------------------------------------------------

def identity_violations(identities: DataFrame, expected: Iterable[tuple[str, str, str, bool]] = ()) -> DataFrame:
    """Crosswalk invariants.  ``expected`` rows must exist exactly once each."""

    def reason(df: DataFrame, entity: str, why: str) -> DataFrame:
        return df.select(F.col(entity).alias("entity_id"), F.lit(why).alias("failure_reason"))

    current = identities.where("is_current_registrant")
    no_single = (
        identities.groupBy("company_key")
        .agg(F.count_if("is_current_registrant").alias("n"))
        .where("n <> 1")
    )
    found = reason(no_single, "company_key", "a company needs one current registrant, no more and no fewer").unionByName(
        reason(
            multivalued(current, ["current_ticker"], "company_key"),
            "current_ticker",
            "several companies trade under this ticker today",
        )
    ).unionByName(
        reason(
            multivalued(identities, ["source_cik"], "company_key"),
            "source_cik",
            "registrant is assigned to several companies",
        )
    )
    expected = list(expected)
    if expected:
        fields = ["company_key", "source_cik", "registrant_role", "is_current_registrant"]
        wanted = literal_table(
            identities.sparkSession, expected, T.StructType([IDENTITY_MAPPING_SCHEMA[f] for f in fields])
        )
        keys = wanted.columns
        counts = identities.groupBy(*keys).agg(F.count("*").alias("n"))
        missing = wanted.join(counts, keys, "left").where(F.coalesce("n", F.lit(0)) != 1)
        found = found.unionByName(
            missing.select(
                F.col("company_key").alias("entity_id"),
                F.concat(
                    F.col("company_key"),
                    F.lit(" "),
                    F.col("registrant_role"),
                    F.lit(" (CIK "),
                    F.col("source_cik"),
                    F.lit(", role "),
                    F.col("registrant_role"),
                    F.when(F.col("is_current_registrant"), ", current").otherwise(", non-current"),
                    F.lit(") must exist exactly once"),
                ).alias("failure_reason"),
            )
        )
    return found


def inconsistent_metric_names(mapping: DataFrame) -> DataFrame:
    return multivalued(mapping, ["metric_key"], "metric_name")


# --- daily performance ----------------------------------------------------------

def daily_metric_violations(mart: DataFrame) -> DataFrame:
    """Rows whose previous close, change or return differs from a recomputation."""
    window = Window.partitionBy("company_key").orderBy(F.col("trading_date").asc())
    checked = mart.select(
        "company_key",
        "trading_date",
        "close",
        "previous_close",
        "daily_change",
        "daily_return",
        F.row_number().over(window).alias("row_num"),
        F.lag("close").over(window).alias("expected_previous_close"),
    )
    close, previous = F.col("close"), F.col("previous_close")
    change, returned = F.col("daily_change"), F.col("daily_return")
    has_previous = previous.isNotNull()
    has_base = has_previous & (previous != 0)
    wrong = (
        ((F.col("row_num") == 1) & (has_previous | change.isNotNull() | returned.isNotNull()))
        | ((F.col("row_num") > 1) & differs(previous, F.col("expected_previous_close")))
        | (has_previous & (change.isNull() | (F.abs(change - exact_difference(close, previous, 18)) > TOLERANCE)))
        | (has_base & (returned.isNull() | (F.abs(returned - simple_return(close, previous)) > TOLERANCE)))
        | ((~has_base) & returned.isNotNull())
    )
    return checked.where(F.coalesce(wrong, F.lit(False)))


# --- financial growth -----------------------------------------------------------

def growth_metric_violations(mart: DataFrame) -> DataFrame:
    """Seven rules over the previous-period and growth columns, checked in one pass."""
    checked = with_previous(
        mart,
        ["company_key", "metric_key", "unit"],
        "end_date",
        {"_expected_end": "end_date", "_expected_value": "current_value"},
    )
    end, value = F.col("_expected_end"), F.col("_expected_value")
    change, growth = F.col("absolute_change"), F.col("growth_rate")
    has_previous = end.isNotNull()
    annual = has_previous & is_annual_gap(F.col("end_date"), end)
    gap = has_previous & ~is_annual_gap(F.col("end_date"), end)
    current = F.col("current_value")
    expected_change = exact_difference(current, value, 10)
    rules = {
        "previous period end is not that of the period before": differs(F.col("previous_end_date"), end),
        "previous value is not that of the period before": differs(F.col("previous_value"), value),
        "a first period cannot be compared with anything": end.isNull()
        & (
            F.col("previous_end_date").isNotNull()
            | F.col("previous_value").isNotNull()
            | change.isNotNull()
            | growth.isNotNull()
        ),
        "change over one year is not the difference of the values": annual & (change.isNull() | (change != expected_change)),
        "growth over one year is not the change over the size of the base": annual
        & (value != 0)
        & (growth.isNull() | (growth != growth_rate(current, value, 10))),
        "growth on a base of zero must stay empty": annual
        & (value == 0)
        & (change.isNull() | (change != current) | growth.isNotNull()),
        "periods a gap apart keep the previous period but no change or growth": gap
        & (
            (F.col("previous_end_date") != end)
            | (F.col("previous_value") != value)
            | change.isNotNull()
            | growth.isNotNull()
        ),
    }
    return violations(checked, GROWTH_GRAIN, rules)


def representative_fact_violations(
    mart: DataFrame, facts: DataFrame, identities: DataFrame, metrics: DataFrame
) -> DataFrame:
    """Each mart row must exist in the facts, have a valid shape and not be outranked.

    "No better candidate exists" is proved with the best (filed date, accession) of
    each grain, one aggregate row per key instead of all candidate pairs.  Both proofs
    start from the same distinct rows, so the candidates are shuffled once.
    """
    source_key = ["source_cik", "accession_number", "metric_key", "end_date", "unit", "period_type"]
    candidates = annual_candidates(facts, identities, metrics)
    seen = candidates.select("company_key", *source_key, "filed_date").distinct()
    best = seen.groupBy(*GROWTH_GRAIN).agg(F.max(F.struct("filed_date", "accession_number")).alias("_best"))
    sources = seen.select(*source_key).distinct().withColumn("_source", F.lit(True))
    checked = mart.join(sources, source_key, "left").join(best, GROWTH_GRAIN, "left")
    form, start, end = F.col("form"), F.col("start_date"), F.col("end_date")
    rules = {
        "no annual fact of the company stands behind the row": F.col(
            "_source"
        ).isNull(),
        "form or period length is not annual": ~form.isin(ANNUAL_FORMS)
        | (
            F.col("period_type").isin("duration", "instant")
            & ~has_annual_shape(F.col("period_type"), start, end)
        ),
        "a later filing reports the same period": F.col("_best")
        > F.struct("filed_date", "accession_number"),
    }
    return violations(checked, GROWTH_GRAIN, rules)


# --- market / macro -------------------------------------------------------------

ALIGNED_KEY = ["company_key", "trading_date", "series_id"]


def _with_expected(mart: DataFrame, fact_macro: DataFrame, days: DataFrame | None) -> DataFrame:
    """The mart with the alignment recomputed.

    The observation in force is worked out once per (series, calendar day); the mart is
    then read once and meets it by equality.  ``days`` is a one-row frame of bounds that
    hold all trading dates, taken from the mart itself if it is not given.
    """
    in_force = filled_forward(
        fact_macro,
        day_bounds(mart, "trading_date") if days is None else days,
        by=["series_id"],
        on="observation_date",
        day="trading_date",
        take={"_expected_date": "observation_date", "_expected_value": "value"},
    )
    return mart.join(measured(in_force, "series_id", "trading_date"), ["series_id", "trading_date"], "left")


def alignment_violations(mart: DataFrame, fact_macro: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Five rules on observation date and age.

    The date in force on a day answers both "is it the latest" and "is there a later one".
    """
    checked = _with_expected(mart, fact_macro, days)
    stored, expected = F.col("macro_observation_date"), F.col("_expected_date")
    day, age = F.col("trading_date"), F.col("macro_age_days")
    rules = {
        "observation in force on the day is another one": differs(stored, expected),
        "observation lies in the future of the day": stored > day,
        "a more recent observation was known": expected > stored,
        "age differs from the days since the observation": stored.isNotNull()
        & (differs(age, days_between(day, stored)) | (age < 0)),
        "nothing was observed yet, but the row carries values": expected.isNull()
        & (stored.isNotNull() | F.col("macro_value").isNotNull() | age.isNotNull()),
    }
    return violations(checked, ALIGNED_KEY, rules)


def preservation_violations(mart: DataFrame, fact_macro: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Rows whose date or value is not that of the latest eligible observation."""
    checked = _with_expected(mart, fact_macro, days)
    rules = {
        "date or value differs from the observation in force": differs(
            F.col("macro_observation_date"), F.col("_expected_date")
        )
        | differs(F.col("macro_value"), F.col("_expected_value"))
    }
    return violations(checked, ALIGNED_KEY, rules)


#: Series in one row of bits; one bit more than the last still fits a long.
_WORD = 62


def _found(series_id: Column, why: str) -> Column:
    return F.struct(series_id.alias("series_id"), F.lit(why).alias("failure_reason"))


def grid_violations(performance: DataFrame, series: DataFrame, mart: DataFrame) -> DataFrame:
    """Missing and unexpected (company, day, series) combinations, both ways.

    Known series are numbered, and every company day is reduced to bits: those of the series
    it should have and of those it has, 62 series a row.  A traded day must have exactly the
    known ones, any other day none.  The expected grid itself is never built, and rows are
    reduced before they are shuffled.
    """
    day_key = ["company_key", "trading_date"]
    known = series.agg(F.array_sort(F.collect_set("series_id"))).scalar()
    none, first, size = F.lit(0).cast("bigint"), F.col("word") * _WORD, F.size("_known")
    # A NULL in the key equals nothing, so the two sides stay apart there.
    apart = F.col("company_key").isNull() | F.col("trading_date").isNull()

    words = F.when(size > 0, F.sequence(F.lit(0), F.floor((size - 1) / _WORD).cast("int")))
    wanted = F.expr(f"shiftleft(1L, least({_WORD}, size(_known) - word * {_WORD})) - 1")
    traded = (
        performance.select(*day_key, known.alias("_known"))
        .select(*day_key, "_known", F.explode(words).alias("word"))
        .select(
            *day_key, "word", F.lit(None).cast("string").alias("stranger"), F.when(apart, "traded").alias("side"),
            wanted.alias("wanted"), none.alias("present"),
        )
    )
    place = F.array_position(known, F.col("series_id")).cast("int") - 1
    present = (
        mart.where(F.col("series_id").isNotNull())
        .select(*day_key, "series_id", place.alias("_place"))
        .select(
            *day_key,
            F.when(F.col("_place") >= 0, F.floor(F.col("_place") / _WORD).cast("int")).alias("word"),
            F.when(F.col("_place") < 0, F.col("series_id")).alias("stranger"),
            F.when(apart, "present").alias("side"),
            none.alias("wanted"),
            F.when(F.col("_place") >= 0, F.expr(f"shiftleft(1L, _place % {_WORD})")).otherwise(none).alias("present"),
        )
    )
    both = (
        traded.unionByName(present)
        .groupBy(*day_key, "word", "stranger", "side")
        .agg(F.bit_or("wanted").alias("wanted"), F.bit_or("present").alias("present"))
        .where("wanted <> present OR stranger IS NOT NULL")
        .withColumn("_known", known)
    )

    def rows(bits: str, why: str) -> Column:
        """The known series at the bits of a word."""
        places = F.filter(F.sequence(F.lit(0), F.lit(_WORD - 1)), lambda i: F.getbit(F.expr(bits), i) == 1)
        return F.transform(places, lambda i: _found(F.get("_known", first + i), why))

    extra = "row is not part of the grid"
    found = F.concat(
        rows("wanted & ~present", "series is missing on a traded day"),
        rows("present & ~wanted", extra),
        F.when(F.col("stranger").isNotNull(), F.array(_found(F.col("stranger"), extra))).otherwise(F.array()),
    )
    return both.select(*day_key, F.inline(found)).select(*ALIGNED_KEY, "failure_reason")


# --- source tables --------------------------------------------------------------

def _identity(table: str) -> dict[str, Column]:
    source, dataset = CONTRACTS[table].identity
    return {
        "source_row_number": F.col("source_row_number") >= 0,
        "identity": (F.col("source") == source) & (F.col("dataset") == dataset),
    }


def _text_checks(*columns: str) -> dict[str, Column]:
    return {f"{c}_nonblank": F.when(F.col(c).isNotNull(), is_not_blank(F.col(c))) for c in columns}


def table_checks(table: str) -> dict[str, Column]:
    """Row checks of a source table, by name; each is true for a good row."""
    c = F.col
    if table == "ingestion_runs":
        return {
            **_text_checks("source", "dataset"),
            "run_id_format": c("run_id").rlike(RUN_ID_PATTERN),
            **_text_checks("raw_json_path", "parquet_path"),
            "artifact_paths_distinct": c("raw_json_path") != c("parquet_path"),
            "record_count": c("record_count") >= 0,
        }
    checks = _identity(table)
    if table == "market_daily_prices":
        checks |= {
            **_text_checks("symbol"),
            "volume": c("volume") >= 0,
            "high_low": c("high") >= c("low"),
            "high_open": c("high") >= c("open"),
            "high_close": c("high") >= c("close"),
            "low_open": c("low") <= c("open"),
            "low_close": c("low") <= c("close"),
        }
    elif table == "sec_submissions":
        checks |= {
            "cik": c("cik").rlike(r"^[0-9]{10}\z"),
            **_text_checks("company_name", "accession_number", "form"),
            "size": c("size") >= 0,
        }
    elif table == "sec_company_facts":
        checks |= {
            "cik": c("cik").rlike(r"^[0-9]{10}\z"),
            **_text_checks("entity_name", "taxonomy", "concept", "unit", "accession_number", "form"),
            "date_range": c("start_date") <= c("end_date"),
        }
    elif table == "fred_series_metadata":
        checks |= {
            **_text_checks(
                "series_id",
                "title",
                "frequency",
                "frequency_short",
                "units",
                "units_short",
                "seasonal_adjustment",
                "seasonal_adjustment_short",
            ),
            "realtime_range": c("realtime_start") <= c("realtime_end"),
            "observation_range": c("observation_start") <= c("observation_end"),
            "popularity": c("popularity") >= 0,
        }
    elif table == "fred_series_observations":
        checks |= {
            **_text_checks("series_id"),
            "realtime_range": c("realtime_start") <= c("realtime_end"),
        }
    return checks


def check_violations(df: DataFrame, table: str) -> DataFrame:
    keys = RUN_KEY if table == "ingestion_runs" else [*RUN_KEY, "source_row_number"]
    return failed_checks(df, keys, table_checks(table))


def key_violations(df: DataFrame, table: str, runs: DataFrame) -> DataFrame:
    """Primary key, unique key and foreign key violations of a source table, by run."""
    contract = CONTRACTS[table]

    def per_run(bad: DataFrame, why: str) -> DataFrame:
        return bad.groupBy(*RUN_KEY).agg(F.count("*").alias("keys")).withColumn("constraint", F.lit(why))

    found = per_run(duplicates(df, [*RUN_KEY, "source_row_number"]), "primary key")
    if contract.run_grain:
        found = found.unionByName(per_run(duplicates(df, [*RUN_KEY, *contract.run_grain]), "unique grain"))
    return found.unionByName(per_run(orphans(df, runs, RUN_KEY, RUN_KEY), "registered run"))


def required_columns(table: str) -> list[str]:
    return [f.name for f in CONTRACTS[table].schema.fields if not f.nullable]


# --- rule sets ------------------------------------------------------------------

#: Columns that must not be NULL, per modelled relation.
REQUIRED = {
    "dim_company": ["cik", "entity_name"],
    "dim_date": ["date_day", "year", "quarter", "month", "day_of_month", "day_of_week", "is_weekend"],
    "dim_financial_metric": ["metric_key", "metric_name", "period_type"],
    "dim_macro_series": ["series_id"],
    "fact_market_daily": ["symbol", "trading_date", "open", "high", "low", "close"],
    "fact_financial_reported": [
        "cik", "metric_key", "taxonomy", "concept", "unit", "value", "end_date", "accession_number", "form", "filed_date",
    ],
    "fact_macro_observation": ["series_id", "observation_date", "realtime_start", "realtime_end"],
    "mart_company_daily_performance": [
        "company_key", "current_ticker", "current_cik", "company_name", "trading_date", "open", "high", "low", "close",
    ],
    "mart_company_financial_growth": [
        "company_key", "current_ticker", "source_cik", "metric_key", "metric_name", "period_type", "taxonomy",
        "concept", "unit", "end_date", "current_value", "form", "filed_date", "accession_number",
    ],
    "mart_market_macro": [
        "company_key", "current_ticker", "current_cik", "company_name", "trading_date", "series_id", "market_close",
    ],
}

#: Grain of every modelled relation.
GRAINS = {
    "stg_market_prices": ["symbol", "trading_date"],
    "stg_macro_observations": ["series_id", "observation_date", "realtime_start", "realtime_end"],
    "dim_company": ["cik"],
    "dim_date": ["date_day"],
    "dim_financial_metric": ["metric_key"],
    "dim_macro_series": ["series_id"],
    "fact_market_daily": ["symbol", "trading_date"],
    "fact_macro_observation": ["series_id", "observation_date"],
    "mart_company_daily_performance": ["company_key", "trading_date"],
    "mart_company_financial_growth": GROWTH_GRAIN,
    "mart_market_macro": ALIGNED_KEY,
}

#: child relation, child column, parent relation, parent column.
REFERENCES = [
    ("fact_financial_reported", "cik", "dim_company", "cik"),
    ("fact_financial_reported", "metric_key", "dim_financial_metric", "metric_key"),
    ("fact_macro_observation", "series_id", "dim_macro_series", "series_id"),
    ("mart_company_daily_performance", "current_cik", "dim_company", "cik"),
    ("mart_company_financial_growth", "source_cik", "dim_company", "cik"),
    ("mart_company_financial_growth", "metric_key", "dim_financial_metric", "metric_key"),
    ("mart_market_macro", "current_cik", "dim_company", "cik"),
    ("mart_market_macro", "series_id", "dim_macro_series", "series_id"),
]

#: relation, date column that the calendar must cover.
COVERED_DAYS = [
    ("fact_market_daily", "trading_date"),
    ("fact_financial_reported", "end_date"),
    ("fact_financial_reported", "filed_date"),
    ("fact_macro_observation", "observation_date"),
]


def summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Check name, number of violating rows and status, for a set of checks."""
    parts = [
        df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, df in checks.items()
    ]
    merged = parts[0]
    for more in parts[1:]:
        merged = merged.unionByName(more)
    return merged.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("error"))
