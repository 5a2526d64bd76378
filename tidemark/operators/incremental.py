"""Incremental refresh: watermarks, plans, registration, replay checks and upserts.

All operators handle every entity and run of a batch in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators.relational import differs, latest_dates
from tidemark.schemas import INGESTION_RUNS_SCHEMA, RUN_KEY, require_schema

# Days re-read before the watermark, per feed.
PRICE_OVERLAP_DAYS = 3
OBSERVATION_OVERLAP_DAYS = 365

#: Registry columns a replayed run must repeat exactly.
REPLAYED_FIELDS = ["ingested_at", "raw_json_path", "parquet_path", "record_count"]


def watermarks(table: DataFrame, entity: str, day: str) -> DataFrame:
    """High-water mark of every entity."""
    return latest_dates(table, entity, day).withColumnRenamed("latest_date", "watermark")


def lower_bound(watermark: Column, overlap_days: int) -> Column:
    """First day to re-read; NULL without history."""
    if isinstance(overlap_days, bool) or not isinstance(overlap_days, int) or overlap_days < 0:
        raise ValueError("overlap days must be a non-negative integer")
    return F.date_sub(watermark, overlap_days)


def entity_plan(requested: DataFrame, entity: str, normalise=text.normalised_symbol) -> DataFrame:
    """Normalised request list.  A blank or repeated key is reported, not dropped.

    ``requested`` has ``position`` (request order) and the entity column.  Repeats are
    counted with a partial aggregation, so a key repeated very often stays cheap.
    """
    key = normalise(F.col(entity))
    counted = requested.select("position", key.alias(entity)).groupBy(entity).agg(
        F.min("position").alias("position"), F.count("*").alias("requests")
    )
    problem = F.when(~text.is_not_blank(F.col(entity)), F.lit("key must not be blank")).when(
        F.col("requests") > 1, F.lit("duplicate key")
    )
    return counted.select("position", entity, problem.alias("problem"))


def refresh_plan(
    entities: DataFrame,
    marks: DataFrame,
    entity: str,
    *,
    overlap_days: int,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Bounds per entity: an explicit range wins, else watermark minus overlap, else full."""
    if start is not None and end is not None and start > end:
        raise ValueError("start must not be after end")
    planned = entities.join(marks, entity, "left")
    if start is not None or end is not None:
        mode, first = F.lit("explicit"), F.lit(start).cast("date")
    else:
        first = lower_bound(F.col("watermark"), overlap_days)
        mode = F.when(first.isNull(), "full").otherwise("incremental")
    return planned.select(
        entity,
        "watermark",
        mode.alias("mode"),
        first.alias("start_date"),
        F.lit(end).cast("date").alias("end_date"),
    )


def paired_range(start: date | None, end: date | None) -> None:
    """Price requests take both ends of an explicit range or neither."""
    if (start is None) != (end is None):
        raise ValueError("start and end must be given together")
    if start is not None and end is not None and start > end:
        raise ValueError("start must not be after end")


def within_plan(incoming: DataFrame, plan: DataFrame, entity: str, day: str) -> DataFrame:
    """Incoming rows inside the planned bounds of their entity."""
    bounds = plan.select(entity, "start_date", "end_date")
    joined = incoming.join(bounds, entity, "inner")
    after = F.col("start_date").isNull() | (F.col(day) >= F.col("start_date"))
    before = F.col("end_date").isNull() | (F.col(day) <= F.col("end_date"))
    return joined.where(after & before).drop("start_date", "end_date")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def classify_upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merged rows with an ``action``: inserted, updated, unchanged or kept.

    Rows only in ``current`` are kept.  Both sides must be unique per key; check
    ``incoming`` with ``duplicate_keys`` first, repeats are an error of the batch.
    """
    keys = list(keys)
    values = [c for c in current.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*values).alias(name))

    both = side(current, "_old").join(side(incoming, "_new"), keys, "full_outer")
    old, new = F.col("_old"), F.col("_new")
    action = (
        F.when(new.isNull(), "kept")
        .when(old.isNull(), "inserted")
        .when(differs(old, new), "updated")
        .otherwise("unchanged")
    )
    merged = both.select(*keys, F.coalesce(new, old).alias("_row"), action.alias("action"))
    return merged.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values], "action")


def upsert_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated, unchanged, total."""
    return merged.agg(
        *[F.count_if(F.col("action") == a).alias(a) for a in ("inserted", "updated", "unchanged")],
        F.count("*").alias("total"),
    )


class DuplicateKeys(ValueError):
    """A batch holds a natural key more than once."""


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``classify_upsert`` that refuses a batch with repeated keys."""
    clash = duplicate_keys(incoming, keys).head()
    if clash is not None:
        raise DuplicateKeys(f"duplicate natural key in incoming rows: {clash.asDict()}")
    return classify_upsert(current, incoming, keys)


def run_range(runs: DataFrame) -> tuple[str | None, str | None]:
    """First and last run id of a batch."""
    first, last = runs.agg(F.min("run_id"), F.max("run_id")).head()
    return first, last


def same_runs(stored: DataFrame, runs: DataFrame, between: tuple[str | None, str | None]) -> DataFrame:
    """Stored rows of the given runs, without scanning the whole history.

    Run ids start with their instant, so the files of one load hold a narrow range of
    them.  The range of the wanted ids goes to the scan as a filter, which skips all
    other row groups by their statistics; the semi join then picks the exact runs.
    """
    first, last = between
    return stored.where(F.col("run_id").between(F.lit(first), F.lit(last))).join(runs, RUN_KEY, "left_semi")


def stored_counts(*tables: DataFrame) -> DataFrame:
    """Rows stored per run, over all given source tables."""
    counts = [t.groupBy(*RUN_KEY).agg(F.count("*").alias("stored_count")) for t in tables]
    merged = counts[0]
    for more in counts[1:]:
        merged = merged.unionByName(more)
    return merged


def classify_runs(incoming: DataFrame, registry: DataFrame, stored: DataFrame) -> DataFrame:
    """State of every incoming run: absent, verified_replay or mismatch with field names.

    A registered run is a verified replay only if all registry fields repeat and the
    stored rows number ``record_count``.  ``stored_count`` tells, for an absent run,
    whether an interrupted load has left its rows behind.
    """
    old = registry.select(*RUN_KEY, F.struct(*REPLAYED_FIELDS).alias("_old"))
    joined = incoming.join(old, RUN_KEY, "left").join(stored, RUN_KEY, "left")
    known = F.col("_old").isNotNull()
    wrong_fields = [F.when(differs(F.col(f), F.col(f"_old.{f}")), F.lit(f)) for f in REPLAYED_FIELDS]
    wrong_count = F.when(
        F.coalesce("stored_count", F.lit(0)) != F.col("record_count"), F.lit("source_row_count")
    )
    mismatched = F.when(known, F.array_compact(F.array(*wrong_fields, wrong_count)))
    return joined.select(
        *incoming.columns,
        F.coalesce("stored_count", F.lit(0)).alias("stored_count"),
        F.when(~known, "absent").when(F.size(mismatched) == 0, "verified_replay").otherwise("mismatch").alias("state"),
        F.coalesce(mismatched, F.array().cast("array<string>")).alias("mismatched"),
    )


def unregistered(incoming: DataFrame, registry: DataFrame) -> DataFrame:
    """Incoming runs the registry does not have yet (insert, on conflict do nothing)."""
    return incoming.join(registry.select(*RUN_KEY), RUN_KEY, "left_anti")


def register(incoming: DataFrame, registry: DataFrame, loaded_at: Column) -> DataFrame:
    """New registry rows, stamped with the load time."""
    new = unregistered(incoming, registry).withColumn("loaded_at", loaded_at)
    return require_schema(new.select(*INGESTION_RUNS_SCHEMA.names), INGESTION_RUNS_SCHEMA, what="registry")


def classify_pairs(states: DataFrame, first: str, second: str, source: str) -> DataFrame:
    """All-or-nothing state of paired datasets, per run.

    Both datasets of an entity carry the same run id and instant.  ``problem`` is NULL
    when both are new or both are verified replays.
    """
    mine = states.where((F.col("source") == source) & F.col("dataset").isin(first, second))
    pairs = mine.groupBy("source", "run_id").agg(
        F.count_if(F.col("dataset") == first).alias("_first"),
        F.count_if(F.col("dataset") == second).alias("_second"),
        F.min("state").alias("_low"),
        F.max("state").alias("_high"),
        F.min("ingested_at").alias("_from"),
        F.max("ingested_at").alias("_to"),
    )
    problem = (
        F.when((F.col("_first") != 1) | (F.col("_second") != 1), "paired datasets do not share a run")
        .when(F.col("_from") != F.col("_to"), "paired datasets do not share an instant")
        .when((F.col("_low") == "mismatch") | (F.col("_high") == "mismatch"), "a paired run is not an exact replay")
        .when(F.col("_low") != F.col("_high"), "pair is partially committed")
    )
    return pairs.select(
        "source", "run_id", F.when(problem.isNull(), F.col("_low")).alias("state"), problem.alias("problem")
    )


#: What becomes of a payload in a load.
LOADED, REPLAYED, REFUSED, WAITING, QUARANTINED = "loaded", "replayed", "refused", "waiting", "quarantined"


def run_dispositions(
    states: DataFrame, rejected: DataFrame, pairs: Sequence[tuple[str, str, str]], known: Sequence[tuple[str, str]]
) -> DataFrame:
    """What becomes of every payload: run columns, ``entity``, ``disposition`` and ``reason``.

    ``states`` are the accepted payloads as ``classify_runs`` describes them, ``rejected``
    the quarantined ones with their reason.  Each run is judged by itself and with its
    partner, so a broken one never holds up others:

    * a run is loaded when it is new, replayed when it repeats the registry exactly, and
      refused when it contradicts the registry or its stored rows;
    * paired datasets (source, first, second) are loaded together.  A new half waits while
      its partner has not arrived and is refused when the partner was rejected;
    * several payloads of one run contradict each other; all of them are refused.

    Runs meet their partners by an aggregate per (source, run); there are two payloads in it.
    """
    own = (
        F.when(F.col("state") == "mismatch", F.concat(F.lit("differs from the registered run in "), F.array_join("mismatched", ", ")))
        .when((F.col("state") == "absent") & ~F.col("stored_count").isin(0) & (F.col("stored_count") != F.col("record_count")), "rows of the run are stored in part")
    )
    everything = states.select(
        *RUN_KEY, "entity", "ingested_at", "state", own.alias("problem"), F.lit(None).cast("string").alias("rejection")
    ).unionByName(
        rejected.select(
            *RUN_KEY, "entity", F.lit(None).cast("timestamp").alias("ingested_at"), F.lit(None).cast("string").alias("state"),
            F.lit(None).cast("string").alias("problem"), F.col("reason").alias("rejection"),
        )
    )
    partner = F.lit(None).cast("string")
    for source, first, second in pairs:
        if {(source, first), (source, second)} <= set(known):
            here = F.col("source") == source
            partner = F.when(here & (F.col("dataset") == first), second).when(here & (F.col("dataset") == second), first).otherwise(partner)
    here = F.struct("dataset", "ingested_at", "state", "problem", "rejection")
    by_run = everything.groupBy("source", "run_id").agg(F.collect_list(here).alias("_run"))
    placed = everything.withColumn("_partner", partner).join(by_run, ["source", "run_id"])
    mine = F.filter("_run", lambda x: x["dataset"] == F.col("dataset"))
    other = F.filter("_run", lambda x: x["dataset"] == F.col("_partner"))
    placed = placed.select("*", F.size(mine).alias("_copies"), F.get(other, F.lit(0)).alias("_other"), F.size(other).alias("_others"))
    paired = F.col("_partner").isNotNull()
    absent = F.col("state") == "absent"
    found = F.col("_others") == 1
    reason = (
        F.when(F.col("rejection").isNotNull(), F.col("rejection"))
        .when((F.col("_copies") > 1) | (F.col("_others") > 1), "the run came with several payloads")
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(paired & absent & (F.col("_others") == 0), "the other half has not arrived")
        .when(paired & found & F.col("_other.rejection").isNotNull() & absent, "the other half was rejected")
        .when(paired & found & F.col("_other.problem").isNotNull(), "the other half was refused")
        .when(paired & found & (F.col("_other.ingested_at") != F.col("ingested_at")), "the halves carry different instants")
        .when(paired & found & (F.col("_other.state") != F.col("state")), "only one half is registered")
    )
    outcome = (
        F.when(F.col("rejection").isNotNull(), QUARANTINED)
        .when(reason == "the other half has not arrived", WAITING)
        .when(reason.isNotNull(), REFUSED)
        .when(absent, LOADED)
        .otherwise(REPLAYED)
    )
    return placed.select(*RUN_KEY, "entity", outcome.alias("disposition"), reason.alias("reason"))


def partner_of(pairs: Sequence[tuple[str, str, str]]) -> Column:
    """The other dataset of a paired one; NULL for datasets that stand alone."""
    partner = F.lit(None).cast("string")
    for source, first, second in pairs:
        here = F.col("source") == source
        partner = F.when(here & (F.col("dataset") == first), second).when(here & (F.col("dataset") == second), first).otherwise(partner)
    return partner


def after_settled(dispositions: DataFrame, settled: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Halves whose partner an earlier load has refused or quarantined do not wait for it.

    ``settled`` has run columns of halves with a final outcome.  Both halves sent again in one load
    are judged anew; this only concerns a half that comes alone.
    """
    past = settled.select("source", F.col("dataset").alias("_partner"), "run_id").distinct().withColumn("_past", F.lit(True))
    met = dispositions.withColumn("_partner", partner_of(pairs)).join(past, ["source", "_partner", "run_id"], "left")
    late = (F.col("disposition") == WAITING) & F.col("_past")
    return met.select(
        *RUN_KEY,
        "entity",
        F.when(late, REFUSED).otherwise(F.col("disposition")).alias("disposition"),
        F.when(late, "the other half was refused in an earlier load").otherwise(F.col("reason")).alias("reason"),
    )


def settled_halves(dispositions: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Halves that this load refused or quarantined: they leave the waiting state for good."""
    final = F.col("disposition").isin(REFUSED, QUARANTINED) & partner_of(pairs).isNotNull()
    return dispositions.where(final).select(*RUN_KEY, "entity", "disposition", "reason")
