"""Read-only signals: recency, run-count movement, profiles and status roll-ups.

A signal is one row of ``SIGNAL_COLUMNS``.  Statuses are closed: pass, warning, info,
error.  Recency and volume have no thresholds, so their signals are informational.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import percent_delta
from tidemark.functions.text import is_not_blank
from tidemark.operators.relational import in_tuples, latest_dates, literal_table
from tidemark.operators.versions import newest_per_group
from tidemark.schemas import DATASET_SCHEMA, DATASETS

STATUSES = ["pass", "warning", "info", "error"]
SIGNAL_COLUMNS = [
    "check_id",
    "source",
    "dataset",
    "entity_id",
    "dimension",
    "status",
    "as_of",
    "measurements",
    "message",
]

# Message texts per feed (no data, measured).
RECENCY_MESSAGES = {
    "market_latest_trading_date": (
        "No loaded Market observations for this symbol.",
        "Market calendar-day age is informational because no exchange calendar or freshness threshold is configured.",
    ),
    "fred_latest_observation_date": (
        "No loaded FRED observations for this series.",
        "FRED calendar-day age is informational because no source-specific cadence threshold is configured.",
    ),
    "sec_latest_submissions_filing_date": (
        "No loaded SEC submissions for this CIK.",
        "SEC filing calendar-day age is informational because filings are event-driven and no freshness SLA is configured.",
    ),
    "sec_latest_company_facts_filed_date": (
        "No loaded SEC Company Facts for this CIK.",
        "SEC filing calendar-day age is informational because filings are event-driven and no freshness SLA is configured.",
    ),
}
RUN_COUNT_CHECK = "ingestion_run_count_movement"


def _measurements(**values: Column) -> Column:
    """Named measurements as text; NULL stays NULL."""
    return F.array(
        *[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in values.items()]
    )


def ages(table: DataFrame, entity: str, day: str, entities: DataFrame, as_of: date) -> DataFrame:
    """Latest date and calendar-day age per monitored entity; entities without rows stay."""
    latest = latest_dates(table, entity, day)
    return entities.join(latest, entity, "left").select(
        entity, "latest_date", F.datediff(F.lit(as_of), "latest_date").alias("age_calendar_days")
    )


def recency_signals(
    table: DataFrame,
    entity: str,
    day: str,
    entities: DataFrame,
    *,
    check_id: str,
    identity: tuple[str, str],
    as_of: date,
    is_valid: Column | None = None,
) -> DataFrame:
    """One signal per monitored entity.  An entity key that is not valid gives an error."""
    if isinstance(as_of, str) or not isinstance(as_of, date):
        raise ValueError("as_of must be a date")
    no_data, measured_message = RECENCY_MESSAGES[check_id]
    valid = is_not_blank(F.col(entity)) if is_valid is None else is_valid
    latest = F.col("latest_date")
    shown = _measurements(latest_date=latest, age_calendar_days=F.col("age_calendar_days"))
    return ages(table, entity, day, entities, as_of).select(
        F.lit(check_id).alias("check_id"),
        F.lit(identity[0]).alias("source"),
        F.lit(identity[1]).alias("dataset"),
        F.when(valid, F.col(entity)).alias("entity_id"),
        F.lit("freshness").alias("dimension"),
        F.when(valid, "info").otherwise("error").alias("status"),
        F.lit(as_of).alias("as_of"),
        F.when(valid, shown).otherwise(F.array().cast(_MEASUREMENTS)).alias("measurements"),
        F.when(~valid, "Could not measure recency: the entity key is not valid.")
        .when(latest.isNull(), no_data)
        .otherwise(measured_message)
        .alias("message"),
    )


_MEASUREMENTS = "array<struct<name:string,value:string>>"


def latest_two_runs(runs: DataFrame) -> DataFrame:
    """Current and previous run of every dataset, side by side.

    At most two rows per dataset and map task reach the shuffle.
    """
    newest = newest_per_group(runs, ["source", "dataset"], ["ingested_at", "run_id"], k=2)
    order = F.struct("ingested_at", "run_id")
    row = F.struct("record_count", "ingested_at", "run_id")
    paired = newest.groupBy("source", "dataset").agg(
        F.max_by(row, order).alias("_current"), F.min_by(row, order).alias("_oldest"), F.count("*").alias("_runs")
    )
    previous = F.when(F.col("_runs") > 1, F.col("_oldest"))
    flat = paired.select("source", "dataset", "_current", previous.alias("_previous"))
    return flat.select(
        "source",
        "dataset",
        *[
            F.col(f"_{side}.{c}").alias(f"{side}_{c}")
            for side in ("current", "previous")
            for c in ("record_count", "ingested_at", "run_id")
        ],
    )


def run_count_movement(runs: DataFrame) -> DataFrame:
    """Absolute and relative change of the record count between the two newest runs."""
    current, previous = F.col("current_record_count"), F.col("previous_record_count")
    return latest_two_runs(runs).select(
        "*",
        (current - previous).alias("absolute_delta"),
        percent_delta(current, previous).alias("percent_delta"),
        F.lit(False).alias("scope_comparable"),
    )


def run_count_signals(
    runs: DataFrame, as_of: date, datasets: Sequence[tuple[str, str]] = tuple(DATASETS)
) -> DataFrame:
    """One signal per known dataset.  A malformed registry row gives an error signal."""
    known = literal_table(runs.sparkSession, datasets, DATASET_SCHEMA)
    moved = known.join(run_count_movement(in_tuples(runs, ["source", "dataset"], datasets)), ["source", "dataset"], "left")
    c = F.col
    has_run = c("current_run_id").isNotNull() | c("current_record_count").isNotNull()

    def malformed(side: str) -> Column:
        return (
            c(f"{side}_record_count").isNull()
            | (c(f"{side}_record_count") < 0)
            | c(f"{side}_ingested_at").isNull()
            | ~is_not_blank(c(f"{side}_run_id"))
        )

    has_previous = c("previous_run_id").isNotNull() | c("previous_record_count").isNotNull()
    broken = has_run & (malformed("current") | (has_previous & malformed("previous")))
    base = dict(
        current_record_count=c("current_record_count"),
        current_ingested_at=c("current_ingested_at"),
        current_run_id=c("current_run_id"),
        previous_record_count=c("previous_record_count"),
        absolute_delta=c("absolute_delta"),
        percent_delta=c("percent_delta"),
        scope_comparable=F.lit(False),
    )
    both = dict(base, previous_ingested_at=c("previous_ingested_at"), previous_run_id=c("previous_run_id"))
    none = dict(
        current_record_count=F.lit(None),
        previous_record_count=F.lit(None),
        scope_comparable=F.lit(False),
    )
    measurements = (
        F.when(broken, F.array().cast(_MEASUREMENTS))
        .when(~has_run, _measurements(**none))
        .when(has_previous, _measurements(**both))
        .otherwise(_measurements(**base))
    )
    message = (
        F.when(broken, "Could not measure run counts: an ingestion-run row is malformed.")
        .when(~has_run, "No loaded ingestion runs are available for this dataset.")
        .when(
            c("previous_record_count") == 0,
            "Run counts are informational because retrieval scope comparability is not recorded; "
            "percentage movement from zero is undefined.",
        )
        .otherwise("Run counts are informational because retrieval scope comparability is not recorded.")
    )
    return moved.select(
        F.lit(RUN_COUNT_CHECK).alias("check_id"),
        "source",
        "dataset",
        F.lit(None).cast("string").alias("entity_id"),
        F.lit("record_count").alias("dimension"),
        F.when(broken, "error").otherwise("info").alias("status"),
        F.lit(as_of).alias("as_of"),
        measurements.alias("measurements"),
        message.alias("message"),
    )


def collect_signals(frames: Sequence[DataFrame]) -> DataFrame:
    """Signals of several monitors as one frame; ``position`` keeps the monitors in order."""
    merged = None
    for position, frame in enumerate(frames):
        part = frame.select(F.lit(position).alias("position"), *SIGNAL_COLUMNS)
        merged = part if merged is None else merged.unionByName(part)
    return merged


def status_counts(signals: DataFrame, statuses: Sequence[str] = tuple(STATUSES)) -> DataFrame:
    """Signals per status; statuses that do not occur count 0."""
    schema = T.StructType([T.StructField("status", T.StringType(), False)])
    known = literal_table(signals.sparkSession, [(s,) for s in statuses], schema)
    counted = signals.groupBy("status").agg(F.count("*").alias("signal_count"))
    return known.join(counted, "status", "left").select(
        "status", F.coalesce("signal_count", F.lit(0)).alias("signal_count")
    )


def overall_status(checks: DataFrame) -> DataFrame:
    """Worst status of all checks: any error, else any info, else ok."""
    return checks.agg(
        F.when(F.bool_or(F.col("status") == "error"), "error")
        .when(F.bool_or(F.col("status") == "info"), "info")
        .otherwise("ok")
        .alias("status"),
        F.count("*").alias("checks"),
    )


def latest_provenance(runs: DataFrame, datasets: Sequence[tuple[str, str]] = tuple(DATASETS)) -> DataFrame:
    """Newest registered run of every known dataset; datasets without runs stay."""
    known = literal_table(runs.sparkSession, datasets, DATASET_SCHEMA)
    order = F.struct("ingested_at", "run_id")
    row = F.struct("run_id", "ingested_at", "record_count")
    latest = (
        in_tuples(runs, ["source", "dataset"], datasets)
        .groupBy("source", "dataset")
        .agg(F.max_by(row, order).alias("_latest"))
        .select(
            "source",
            "dataset",
            F.col("_latest.run_id").alias("latest_run_id"),
            F.col("_latest.ingested_at").alias("latest_recorded_at"),
            F.col("_latest.record_count").alias("latest_record_count"),
        )
    )
    return known.join(latest, ["source", "dataset"], "left")


def relation_check(spark: SparkSession, expected: Sequence[str]) -> DataFrame:
    """Whether each expected relation can be resolved by name."""
    rows = [(name, spark.catalog.tableExists(name)) for name in expected]
    schema = T.StructType([T.StructField("relation", T.StringType()), T.StructField("present", T.BooleanType())])
    return literal_table(spark, rows, schema).select(
        "relation", "present", F.when(F.col("present"), "ok").otherwise("error").alias("status")
    )


def provenance_details(provenance: DataFrame) -> DataFrame:
    """Newest run of every dataset as one row of text per dataset, with its status.

    ``provenance`` is the frame of ``latest_provenance``.  A dataset nobody has loaded yet
    is informational; a run without its instant or its count cannot be traced.
    """
    run = F.col("latest_run_id")
    untraceable = run.isNotNull() & (F.col("latest_recorded_at").isNull() | F.col("latest_record_count").isNull())
    return provenance.select(
        "source",
        "dataset",
        F.when(untraceable, "error").when(run.isNull(), "info").otherwise("ok").alias("status"),
        F.when(run.isNull(), "no run is registered")
        .otherwise(F.concat(F.lit("run "), run, F.lit(" with "), F.coalesce(F.col("latest_record_count").cast("string"), F.lit("unknown")), F.lit(" records")))
        .alias("detail"),
    )


def operational_checks(
    *, inventory: DataFrame, relations: DataFrame, signals: DataFrame, provenance: DataFrame
) -> DataFrame:
    """Artifact, provenance, relation and recency checks with one status each.

    ``provenance`` is the frame of ``latest_provenance``; ``provenance_details`` lists its
    datasets one by one.
    """
    traced = provenance_details(provenance).agg(F.bool_or(F.col("status") == "error").alias("bad"))
    bronze = inventory.agg(F.bool_or(F.col("latest_pair_present") == F.lit(False)).alias("bad"))
    missing = relations.agg(F.bool_or(~F.col("present")).alias("bad"))
    failed = signals.where("dimension = 'freshness'").agg(F.bool_or(F.col("status") == "error").alias("bad"))

    def check(frame: DataFrame, name: str, good: str, ok: str, bad: str) -> DataFrame:
        is_bad = F.coalesce("bad", F.lit(False))
        return frame.select(
            F.lit(name).alias("check_id"),
            F.when(is_bad, "error").otherwise(good).alias("status"),
            F.when(is_bad, bad).otherwise(ok).alias("message"),
        )

    return (
        check(
            bronze, "bronze", "info", "The newest run directories were looked at; a dataset without data is no fault.",
            "A newest run lacks its payload or its rows.",
        )
        .unionByName(
            check(
                traced, "provenance", "ok", "The newest run of every loaded dataset can be traced.",
                "A newest run has no instant or no record count.",
            )
        )
        .unionByName(
            check(
                missing, "analytics_relations", "ok", "All relations of the model can be read.",
                "Relations of the model are missing.",
            )
        )
        .unionByName(
            check(
                failed, "recency", "info", "Ages are reported without a limit.",
                "Ages could not be worked out.",
            )
        )
    )


def series_profile(observations: DataFrame) -> DataFrame:
    """Row, numeric and missing counts with first and last date of every series."""
    return observations.groupBy("series_id").agg(
        F.count("*").alias("row_count"),
        F.count("value").alias("numeric_count"),
        F.count_if(F.col("value").isNull()).alias("missing_count"),
        F.min("observation_date").alias("first_date"),
        F.max("observation_date").alias("last_date"),
    )
