"""Refresh programs: payloads -> source tables -> stored relations -> checks -> signals."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import incremental, monitoring, payloads, quality
from tidemark.operators.versions import with_provenance
from tidemark.plans import delta
from tidemark.plans.reference_data import macro_series
from tidemark.plans.relations import MARTS, RELATIONS, Relations
from tidemark.schemas import (
    CONTRACTS,
    DATASETS,
    IDENTITY_MAPPING_SCHEMA,
    INGESTION_RUNS_SCHEMA,
    LANDING_SCHEMA,
    METRIC_MAPPING_SCHEMA,
    PRICES,
    RUN_KEY,
    SERIES_OBSERVATIONS,
)
from tidemark.sources import typed
from tidemark.sources.layout import RAW_NAME, TYPED_NAME, run_directory
from tidemark.sources.warehouse import StoredRelation, Version, Warehouse

PAIRS = [("sec_edgar", "submissions", "company_facts"), ("fred", "series_metadata", "series_observations")]

SETTLED_SCHEMA = T.StructType(
    [
        *[LANDING_SCHEMA[c] for c in RUN_KEY],
        T.StructField("entity", T.StringType()),
        T.StructField("disposition", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("decided_at", T.TimestampType()),
    ]
)

#: Relations stored during a refresh; checks and later relations read them from storage.
STORED = RELATIONS


@dataclass
class LoadResult:
    """New registry rows, rejected payloads and what became of every payload."""

    registered: DataFrame
    quarantine: DataFrame
    dispositions: DataFrame


@dataclass
class RefreshResult:
    """Frames describing a finished refresh."""

    registered: DataFrame
    quarantine: DataFrame
    dispositions: DataFrame
    relations: Relations
    checks: DataFrame
    signals: DataFrame
    requests: DataFrame
    paths: dict[str, str] = field(default_factory=dict)


def declared_runs(verdicts: DataFrame, root: str, loaded_at) -> DataFrame:
    """Registry candidates of the accepted payloads."""
    directory = run_directory(root, F.col("source"), F.col("dataset"), F.col("ingested_at"), F.col("entity"))
    return payloads.accepted_counts(verdicts).select(
        *RUN_KEY,
        "ingested_at",
        F.concat(directory, F.lit(f"/{RAW_NAME}")).alias("raw_json_path"),
        F.concat(directory, F.lit(f"/{TYPED_NAME}")).alias("parquet_path"),
        "record_count",
        loaded_at.alias("loaded_at"),
    )


def unknown_payloads(landing: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Payloads of datasets that the load does not handle, as quarantine rows."""
    known = [CONTRACTS[t].identity for t in tables]
    is_known = F.lit(False)
    for source, dataset in known:
        is_known = is_known | (F.col("source").eqNullSafe(source) & F.col("dataset").eqNullSafe(dataset))
    return landing.where(~is_known).select(*RUN_KEY, "entity", F.lit("dataset is not handled by this load").alias("reason"))


def load(
    spark: SparkSession,
    landing: DataFrame,
    tables_root: str,
    *,
    landing_root: str = "landing",
    tables: Sequence[str] = tuple(CONTRACTS),
) -> LoadResult:
    """Parse payloads and append the rows of new runs.

    Every payload gets a disposition of its own (``incremental.run_dispositions``): sound
    runs are loaded whatever else the batch holds, the others are reported.  The half of a
    pair whose partner has not arrived is stored and joins the next load, so the way
    payloads are cut into batches does not change what is loaded.

    Exact replays add nothing.  Rows are written before their registry entries and readers
    join the registry, so an interrupted load stays invisible.  When it is repeated, runs
    whose rows are already complete are only registered.  Intermediate results are written
    below ``tables_root``.
    """
    paths = typed.create_source_tables(spark, tables_root)
    pairs = PairState(spark, tables_root)
    scratch = f"{tables_root.rstrip('/')}/_loads/{uuid.uuid4().hex}"

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    # The load instant is fixed once, not once per action that reads the frame.
    loaded_at = F.lit(spark.range(1).select(F.current_timestamp()).head()[0])
    held = pairs.waiting()
    handled = [CONTRACTS[t].identity for t in tables]
    waited = held.join(landing.select(*RUN_KEY), RUN_KEY, "left_anti")
    batch = keep(landing.select(*LANDING_SCHEMA.names).unionByName(waited), "payloads")

    # Each payload is parsed once; the verdicts feed the registry, the quarantine and the rows.
    verdicts = {
        t: keep(payloads.stored_form(payloads.parse(batch, t), CONTRACTS[t]), f"verdicts/{t}") for t in tables
    }
    declared = _union([declared_runs(v, landing_root, loaded_at) for v in verdicts.values()])
    quarantine = _union([*[payloads.quarantined(v) for v in verdicts.values()], unknown_payloads(batch, tables)])
    entities = _union([payloads.accepted_counts(v).select(*RUN_KEY, "entity") for v in verdicts.values()]).distinct()
    runs = declared.select(*RUN_KEY)
    between = incremental.run_range(runs)
    # Only the days of these runs are read of the stored tables.
    stored = typed.read_source_tables(spark, tables_root, typed.days_of(between))
    history = {t: incremental.same_runs(stored[t], runs, between) for t in (*tables, "ingestion_runs")}
    counts = incremental.stored_counts(*[history[t] for t in tables])
    states = keep(incremental.classify_runs(declared, history["ingestion_runs"], counts), "states")
    judged = incremental.run_dispositions(states.join(entities, RUN_KEY), quarantine, PAIRS, handled)
    dispositions = keep(incremental.after_settled(judged, pairs.settled(), PAIRS), "dispositions")

    sound = dispositions.where(F.col("disposition") == incremental.LOADED).select(*RUN_KEY)
    new = keep(
        states.where("state = 'absent'").join(sound, RUN_KEY, "left_semi").select(*INGESTION_RUNS_SCHEMA.names, "stored_count"),
        "new",
    )
    missing = new.where("stored_count = 0").select(*RUN_KEY)
    # Datasets without new runs get no empty files; there are only as many as tables.
    arrived = {(r.source, r.dataset) for r in missing.select("source", "dataset").distinct().collect()}
    for table, verdict in verdicts.items():
        if CONTRACTS[table].identity in arrived:
            fresh = verdict.join(missing, RUN_KEY, "left_semi")
            typed.append_rows(payloads.accepted_rows(fresh, CONTRACTS[table]), paths[table], CONTRACTS[table].schema)
    new = new.select(*INGESTION_RUNS_SCHEMA.names)
    typed.append_rows(new, paths["ingestion_runs"], INGESTION_RUNS_SCHEMA)
    # Last: halves that were loaded although the state still lists them are replays next time.
    pairs.move_on(batch, dispositions, loaded_at)
    return LoadResult(new, quarantine, dispositions)


class PairState:
    """Halves of pairs between loads: the payloads that wait, and the outcome of those that
    will not be waited for any more.

    Both change together, as one version.  The waiting payloads are written anew when they
    change, so they never hold more than what waits; outcomes are added to the months of their
    runs.
    """

    WAITING, SETTLED = "waiting", "settled"

    def __init__(self, spark: SparkSession, tables_root: str) -> None:
        self.spark = spark
        self.warehouse = Warehouse(spark, f"{tables_root.rstrip('/')}/_pairs")
        self.version = self.warehouse.current()

    def _read(self, name: str, schema: T.StructType, parts=None) -> DataFrame:
        if name not in self.version.relations:
            return self.spark.createDataFrame([], schema)
        return self.warehouse.read(self.version, name, parts)

    def waiting(self) -> DataFrame:
        return self._read(self.WAITING, LANDING_SCHEMA)

    def settled(self) -> DataFrame:
        """Run columns, entity, disposition, reason and the instant of the decision."""
        return self._read(self.SETTLED, SETTLED_SCHEMA)

    def move_on(self, batch: DataFrame, dispositions: DataFrame, decided_at) -> None:
        """Take over what a load decided about the payloads of its batch, waiting ones included."""
        keys = dispositions.where(F.col("disposition") == incremental.WAITING).select(*RUN_KEY)
        known = self.waiting().select(*RUN_KEY)
        final = incremental.settled_halves(dispositions, PAIRS).withColumn("decided_at", decided_at)
        relations = dict(self.version.relations)
        if not keys.exceptAll(known).isEmpty() or not known.exceptAll(keys).isEmpty():
            left = batch.select(*LANDING_SCHEMA.names).join(keys, RUN_KEY, "left_semi")
            relations[self.WAITING] = self.warehouse.write(self.WAITING, left, delta.run_month())
        months = [r[0] for r in final.select(delta.run_month()).distinct().collect()]
        if months:
            earlier = self._read(self.SETTLED, SETTLED_SCHEMA, months)
            # A half that is sent again and refused again has one outcome, the first.
            again = final.join(earlier, RUN_KEY, "left_anti").dropDuplicates(RUN_KEY)
            written = self.warehouse.write(self.SETTLED, earlier.unionByName(again), delta.run_month())
            before = relations.get(self.SETTLED, StoredRelation(written.schema, {}))
            relations[self.SETTLED] = self.warehouse.replaced(before, months, written)
        if relations != self.version.relations:
            self.version = self.warehouse.publish(self.version, relations, {})


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    merged = frames[0]
    for more in frames[1:]:
        merged = merged.unionByName(more)
    return merged


def seed_digest(seed: DataFrame) -> str:
    """The same for equal rows in any order."""
    row = F.xxhash64(F.to_json(F.struct(*seed.columns), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
    count, total = seed.agg(F.count("*"), F.sum(row)).first()
    return f"{count}:{total}"


def build_relations(
    tables: dict[str, DataFrame], identities: DataFrame, metrics: DataFrame, warehouse: Warehouse
) -> Version:
    """All relations from all history, every layer written once and read back from storage.

    They become visible together, when the last one is written.
    """
    before, stored = warehouse.current(), {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        stored[name] = warehouse.write(name, df, delta.part(name))
        return warehouse.read(Version(0, stored), name)

    relations = Relations(tables, identities, metrics, keep, STORED)
    for name in STORED:
        relations[name]
    keep(delta.MONTH_CLOSES, delta.month_closes(relations.fact_market_daily))
    keep(delta.STAGED_RUNS, delta.staged_runs(tables["ingestion_runs"]))
    basis = {"identities": seed_digest(identities), "metrics": seed_digest(metrics)}
    return warehouse.publish(before, stored, basis)


def update_relations(
    spark: SparkSession, source_root: str, identities: DataFrame, metrics: DataFrame, warehouse: Warehouse
) -> Version | None:
    """The relations with all registered runs that staging lacks, whoever registered them.

    Only parts that the rows of these runs reach are written.  None where a full build is
    needed: nothing is published yet, or the seeds have changed.
    """
    before = warehouse.current()
    basis = {"identities": seed_digest(identities), "metrics": seed_digest(metrics)}
    if before.basis != basis or not set(delta.PARTS) <= set(before.relations):
        return None
    runs = typed.read_source_tables(spark, source_root)["ingestion_runs"]
    registered = runs.join(warehouse.read(before, delta.STAGED_RUNS), RUN_KEY, "left_anti")
    between = incremental.run_range(registered)
    if between[0] is None:
        return before
    tables = typed.read_source_tables(spark, source_root, typed.days_of(between))
    arrivals = {
        name: with_provenance(incremental.same_runs(tables[table], registered.select(*RUN_KEY), between), registered)
        for name, (table, _) in delta.STAGED.items()
    }
    stored = dict(before.relations)

    def replace(name: str, rows: DataFrame, parts) -> DataFrame:
        new = warehouse.write(name, rows, delta.part(name))
        stored[name] = warehouse.replaced(stored[name], parts, new)
        return warehouse.read(Version(0, {name: new}), name)

    delta.Delta(
        lambda name, parts, without: warehouse.read(before, name, parts, without), arrivals, identities, metrics, replace
    )
    months = [r[0] for r in registered.select(delta.run_month()).distinct().collect()]
    staged = warehouse.read(before, delta.STAGED_RUNS, months).unionByName(delta.staged_runs(registered))
    replace(delta.STAGED_RUNS, staged, months)
    return warehouse.publish(before, stored, basis)


def published(
    warehouse: Warehouse, version: Version, tables: dict[str, DataFrame], identities: DataFrame, metrics: DataFrame
) -> Relations:
    """The relations of one version, read from storage."""
    return Relations(tables, identities, metrics, lambda name, _: warehouse.read(version, name), STORED)


def run_checks(relations: Relations, expected_identities: Sequence[tuple] = ()) -> dict[str, DataFrame]:
    """Every model check by name; each frame holds the violations."""
    r = relations
    performance, growth, macro = (r[name] for name in MARTS)
    checks: dict[str, DataFrame] = {}
    for name, columns in quality.REQUIRED.items():
        checks[f"{name}.not_null"] = quality.null_counts(r[name], columns)
    for name, grain in quality.GRAINS.items():
        checks[f"{name}.unique"] = quality.duplicates(r[name], grain)
    for child, key, parent, parent_key in quality.REFERENCES:
        checks[f"{child}.{key}.exists"] = quality.orphans(r[child], r[parent], [key], [parent_key])
    for name, column in quality.COVERED_DAYS:
        checks[f"{name}.{column}.in_calendar"] = quality.uncovered_days(r[name], column, r.dim_date)
    checks["dim_date.no_gaps"] = quality.calendar_gaps(r.dim_date)
    checks["growth.period_type"] = quality.unaccepted(growth, "period_type", ["duration", "instant"])
    checks["identities.not_null"] = quality.null_counts(r.identities, IDENTITY_MAPPING_SCHEMA.names)
    checks["identities.unique"] = quality.duplicates(r.identities, ["source_cik"])
    checks["identities.registrant_role"] = quality.unaccepted(
        r.identities, "registrant_role", ["primary", "successor", "predecessor"]
    )
    checks["metrics.not_null"] = quality.null_counts(r.metrics, METRIC_MAPPING_SCHEMA.names)
    checks["metrics.period_type"] = quality.unaccepted(r.metrics, "period_type", ["duration", "instant"])
    checks["identities.invariants"] = quality.identity_violations(r.identities, expected_identities)
    checks["metrics.names"] = quality.inconsistent_metric_names(r.metrics)
    checks["metrics.unique"] = quality.duplicates(r.metrics, ["taxonomy", "concept"])
    checks["performance.derived"] = quality.daily_metric_violations(performance)
    checks["growth.derived"] = quality.growth_metric_violations(growth)
    checks["growth.representative"] = quality.representative_fact_violations(
        growth, r.fact_financial_reported, r.identities, r.dim_financial_metric
    )
    checks["macro.alignment"] = quality.alignment_violations(macro, r.fact_macro_observation)
    checks["macro.preserved"] = quality.preservation_violations(macro, r.fact_macro_observation)
    checks["macro.grid"] = quality.grid_violations(performance, r.dim_macro_series, macro)
    return checks


def run_source_checks(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Row, key and NULL checks of the source tables by name; each frame holds the violations."""
    runs = tables["ingestion_runs"]
    checks = {
        "ingestion_runs.rows": quality.check_violations(runs, "ingestion_runs"),
        "ingestion_runs.unique": quality.duplicates(runs, RUN_KEY),
        "ingestion_runs.not_null": quality.null_counts(runs, INGESTION_RUNS_SCHEMA.names),
    }
    for name in CONTRACTS:
        checks[f"{name}.rows"] = quality.check_violations(tables[name], name)
        checks[f"{name}.keys"] = quality.key_violations(tables[name], name, runs)
        checks[f"{name}.not_null"] = quality.null_counts(tables[name], quality.required_columns(name))
    return checks


def monitor(tables: dict[str, DataFrame], as_of: date, identities: DataFrame, series: DataFrame) -> DataFrame:
    """Signals of all monitored entities, in the order they are reported."""
    current = identities.where("is_current_registrant")
    tickers = current.select(F.col("current_ticker").alias("symbol"))
    registrants = current.select(F.col("source_cik").alias("cik"))
    c = CONTRACTS

    def recency(check: str, table: str, entities: DataFrame) -> DataFrame:
        contract = c[table]
        return monitoring.recency_signals(
            tables[table], contract.entity, contract.watermark, entities,
            check_id=check, identity=contract.identity, as_of=as_of,
        )

    return monitoring.collect_signals(
        [
            recency("market_latest_trading_date", "market_daily_prices", tickers),
            recency("fred_latest_observation_date", "fred_series_observations", series),
            recency("sec_latest_submissions_filing_date", "sec_submissions", registrants),
            recency("sec_latest_company_facts_filed_date", "sec_company_facts", registrants),
            monitoring.run_count_signals(tables["ingestion_runs"], as_of, DATASETS),
        ]
    )


def refresh(
    spark: SparkSession,
    landing: DataFrame,
    root: str,
    *,
    identities: DataFrame,
    metrics: DataFrame,
    as_of: date,
    tables: Sequence[str] = tuple(CONTRACTS),
    expected_identities: Sequence[tuple] = (),
    incremental_staging: bool = False,
) -> RefreshResult:
    """Full refresh: load every dataset, rebuild the relations, check and monitor.

    With ``incremental_staging`` the relations of the last refresh are brought up to date with
    the registered runs they lack: only the parts that these reach are written.  Either way all
    relations change at once, when the new version is published; a refresh that stops before
    leaves the last version as it was.
    """
    root = root.rstrip("/")
    loaded = load(spark, landing, f"{root}/source", landing_root=f"{root}/landing", tables=tables)
    typed.require_whole_files(spark, f"{root}/source")
    sources = typed.read_source_tables(spark, f"{root}/source")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    version = update_relations(spark, f"{root}/source", identities, metrics, warehouse) if incremental_staging else None
    if version is None:
        version = build_relations(sources, identities, metrics, warehouse)
    relations = published(warehouse, version, sources, identities, metrics)
    series = macro_series(spark)
    return RefreshResult(
        registered=loaded.registered,
        quarantine=loaded.quarantine,
        dispositions=loaded.dispositions,
        relations=relations,
        checks=quality.summary({**run_source_checks(sources), **run_checks(relations, expected_identities)}),
        signals=monitor(sources, as_of, identities, series),
        requests=next_requests(relations, identities, series),
        paths={name: f"{warehouse.root}/{name}" for name in STORED},
    )


def next_requests(relations: Relations, identities: DataFrame, series: DataFrame) -> DataFrame:
    """What the next load should ask for: dataset, entity, mode and first day.

    Watermarks come from staging; entities without history are asked for in full.
    """
    symbols = identities.where("is_current_registrant").select(F.col("current_ticker").alias("symbol"))
    plans = []
    for entities, staged, (entity, day), identity, overlap in (
        (symbols, relations.stg_market_prices, ("symbol", "trading_date"), PRICES, incremental.PRICE_OVERLAP_DAYS),
        (
            series.select("series_id"), relations.stg_macro_observations, ("series_id", "observation_date"),
            SERIES_OBSERVATIONS, incremental.OBSERVATION_OVERLAP_DAYS,
        ),
    ):
        marks = incremental.watermarks(staged, entity, day)
        plan = incremental.refresh_plan(entities, marks, entity, overlap_days=overlap)
        plans.append(plan.select(F.lit(identity[1]).alias("dataset"), F.col(entity).alias("entity"), "watermark", "mode", "start_date"))
    return _union(plans)


def daily_refresh(spark: SparkSession, landing: DataFrame, root: str, **options) -> RefreshResult:
    """Weekday refresh: only new price payloads are loaded, and the relations are brought up to
    date with them."""
    source, dataset = PRICES
    prices = landing.where((F.col("source") == source) & (F.col("dataset") == dataset))
    options.setdefault("incremental_staging", True)
    return refresh(spark, prices, root, tables=["market_daily_prices"], **options)


__all__ = [
    "RefreshResult",
    "build_relations",
    "daily_refresh",
    "load",
    "monitor",
    "refresh",
    "run_checks",
    "update_relations",
]
