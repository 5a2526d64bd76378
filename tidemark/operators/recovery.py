"""Checks between captured payloads, typed rows and declared runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.payloads import accepted_rows, typed_fields
from tidemark.schemas import ROW_KEY, RUN_KEY, TableContract

# What to do with a run, decided from its artifacts.
NONE, REBUILT, VERIFIED, ERROR = "none", "rebuilt", "verified", "error"


def _compare(expected: DataFrame, stored: DataFrame, values: list[str]) -> DataFrame:
    """Expected rows (struct ``_expected``) met with stored ones; ``_wrong`` marks differences.

    Rows meet on (run, row number); NULLs compare equal.  A row number stored twice is
    a difference too.
    """
    copies = stored.groupBy(*ROW_KEY).agg(F.first(F.struct(*values)).alias("_stored"), F.count("*").alias("_copies"))
    wrong = ~F.col("_expected").eqNullSafe(F.col("_stored")) | F.coalesce(F.col("_copies") > 1, F.lit(False))
    return expected.join(copies, ROW_KEY, "full_outer").withColumn("_wrong", wrong)


def _values(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in ROW_KEY]


def unequal_runs(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Runs whose stored rows are not exactly the expected ones, with row counts."""
    values = _values(expected.columns)
    rows = expected.select(*ROW_KEY, F.struct(*values).alias("_expected"))
    met = _compare(rows, stored, values)
    return met.groupBy(*RUN_KEY).agg(F.count_if("_wrong").alias("different_rows")).where("different_rows > 0")


#: Sums of the halves of two 64-bit hashes; sums do not depend on the order of rows.
SUMS = ["_s0", "_s1", "_s2", "_s3"]
FINGERPRINT = ["row_count", *SUMS]


def row_digest(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row.  Hashing passes over NULLs, so their places are hashed too."""
    values = [F.col(c) for c in columns]
    nulls = F.array(*[v.isNull() for v in values])
    return F.xxhash64(nulls, *values), F.xxhash64(F.lit("second"), *values, nulls)


def fingerprints(
    rows: DataFrame, is_row: Column | None = None, digest: Callable[[list[str]], tuple[Column, Column]] = row_digest, **more: Column
) -> DataFrame:
    """Per run: number of rows and a 128-bit digest of them that no order changes.

    Rows are reduced before the shuffle, so one row for each run and map task moves.  The run and
    the row number are part of the digest: equal content of two runs has two digests, and a row
    stored twice or under another number changes it.  ``is_row`` tells rows that count.
    """
    columns = [c for c in rows.columns if c not in more]
    first, second = digest(columns)
    halves = [F.shiftrightunsigned(first, 32), first.bitwiseAND(F.lit(0xFFFFFFFF)),
              F.shiftrightunsigned(second, 32), second.bitwiseAND(F.lit(0xFFFFFFFF))]
    counts = F.lit(True) if is_row is None else is_row
    sums = [F.coalesce(F.sum(F.when(counts, h)), F.lit(0)).alias(n) for n, h in zip(SUMS, halves, strict=True)]
    return rows.groupBy(*RUN_KEY).agg(F.count_if(counts).alias("row_count"), *sums, *[v.alias(n) for n, v in more.items()])


def _met(expected: DataFrame, stored: DataFrame, how: str) -> DataFrame:
    """Both fingerprints of every run; ``_differs`` tells runs whose rows are not the same."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*RUN_KEY, *[c for c in df.columns if c not in [*RUN_KEY, *FINGERPRINT]], F.struct(*FINGERPRINT).alias(name))

    none = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in FINGERPRINT])
    met = side(expected, "_expected").join(side(stored, "_stored"), RUN_KEY, how)
    return met.withColumn("_differs", F.coalesce("_expected", none) != F.coalesce("_stored", none))


def payload_fingerprints(verdicts: DataFrame, contract: TableContract) -> DataFrame:
    """Per run: why its payload was rejected, and the fingerprint of the rows it stands for.

    Verdicts are read once.  A rejected or empty payload stands for no rows.
    """
    valid = F.when(F.col("reason").isNull(), F.col("records"))
    rows = verdicts.select(*RUN_KEY, "reason", F.posexplode_outer(valid).alias("source_row_number", "record"))
    typed = rows.select(
        *RUN_KEY, F.col("source_row_number").cast("bigint"), *typed_fields(contract),
        F.col("reason").alias("_reason"), F.col("record").isNotNull().alias("_is_row"),
    )
    digest = [c for c in typed.columns if c not in ("_reason", "_is_row")]
    return fingerprints(
        typed, F.col("_is_row"), lambda _: row_digest(digest), reason=F.max("_reason")
    )


def suspect_runs(
    expected: DataFrame, stored: DataFrame, digest: Callable[[list[str]], tuple[Column, Column]] = row_digest
) -> DataFrame:
    """Runs whose fingerprints differ, and runs that share theirs with another run.

    The run is part of the digest, so a shared one shows that the digest says nothing there.
    """
    columns = expected.columns
    met = _met(fingerprints(expected, digest=digest), fingerprints(stored.select(*columns), digest=digest), "full_outer")
    shared = met.where("_expected.row_count > 0").groupBy("_expected").agg(F.count("*").alias("_runs")).where("_runs > 1")
    clear = met.where("NOT _differs").join(shared.select("_expected"), "_expected", "left_semi")
    return met.where("_differs").select(*RUN_KEY).unionByName(clear.select(*RUN_KEY))


def verified_rows(
    expected: DataFrame, stored: DataFrame, digest: Callable[[list[str]], tuple[Column, Column]] = row_digest
) -> DataFrame:
    """``unequal_runs`` that compares rows of suspect runs only.

    When every fingerprint agrees, which is the normal case, no row is shuffled.
    """
    suspects = suspect_runs(expected, stored, digest)
    if suspects.isEmpty():
        return unequal_runs(expected.limit(0), stored.limit(0))
    return unequal_runs(
        expected.join(suspects, RUN_KEY, "left_semi"), stored.join(suspects, RUN_KEY, "left_semi")
    )


def recover_or_verify(
    manifest: DataFrame,
    landing: DataFrame,
    stored: DataFrame,
    parser: Callable[[DataFrame], DataFrame],
    contract: TableContract,
) -> DataFrame:
    """Outcome of every run in the manifest, in one job.

    Only a payload: its rows can be rebuilt.  Payload and typed rows: they must be
    equal.  Typed rows alone, stray artifacts or a payload that does not parse need an
    operator.  Rows are compared by the fingerprints of their runs and never shuffled.
    """
    expected = payload_fingerprints(parser(landing), contract)
    found = _met(expected, fingerprints(stored.select(*contract.schema.names)), "full_outer")
    joined = manifest.join(found, RUN_KEY, "left")
    problem = (
        F.when(F.col("stray_count") > 0, "run contains unexpected artifacts")
        .when(F.col("typed_present") & ~F.col("raw_present"), "typed artifact without a payload")
        .when(F.col("raw_present") & F.col("reason").isNotNull(), F.concat(F.lit("payload cannot be parsed: "), "reason"))
        .when(
            F.col("raw_present") & F.col("typed_present") & F.col("_differs"),
            "typed rows do not match the captured payload",
        )
    )
    outcome = (
        F.when(problem.isNotNull(), ERROR)
        .when(~F.col("raw_present") & ~F.col("typed_present"), NONE)
        .when(~F.col("typed_present"), REBUILT)
        .otherwise(VERIFIED)
    )
    return joined.select(*RUN_KEY, outcome.alias("outcome"), problem.alias("problem"))


def rebuilt_rows(outcomes: DataFrame, landing: DataFrame, parser, contract: TableContract) -> DataFrame:
    """Typed rows of the runs to rebuild."""
    runs = outcomes.where(F.col("outcome") == REBUILT).select(*RUN_KEY)
    return accepted_rows(parser(landing.join(runs, RUN_KEY, "left_semi")), contract)


def preflight(runs: DataFrame, rows: DataFrame, contract: TableContract) -> DataFrame:
    """Check declared runs against their typed rows before anything is registered.

    ``runs`` declares source, dataset, run id, entity, the two artifact paths, the
    canonical ones and a record count.  Every run comes back with its first problem.
    """
    source, dataset = contract.identity
    actual = rows.groupBy(*RUN_KEY).agg(
        F.count("*").alias("_rows"),
        F.min(contract.entity).alias("_low"),
        F.max(contract.entity).alias("_high"),
    )
    declared = runs.join(actual, RUN_KEY, "left")
    count = F.coalesce("_rows", F.lit(0))
    single = F.lit(contract.name == "fred_series_metadata")
    problem = (
        F.when(F.col("source") != source, f"source must be {source}")
        .when(F.col("dataset") != dataset, f"dataset must be {dataset}")
        .when(F.col("raw_json_path") != F.col("canonical_raw_path"), "raw JSON path is not canonical")
        .when(F.col("parquet_path") != F.col("canonical_parquet_path"), "Parquet path is not canonical")
        .when(F.col("record_count").isNull() | (F.col("record_count") < 0), "record count must not be negative")
        .when(count != F.col("record_count"), "record count does not match the row count")
        .when(single & (count != 1), "series metadata must have exactly one row")
        .when(F.col("_low") != F.col("_high"), "rows name more than one entity")
        .when(F.col("_low") != F.col("entity"), "rows do not match the run's entity")
    )
    return declared.select(*runs.columns, problem.alias("problem"))


def paired_runs(runs: DataFrame, first: str, second: str) -> DataFrame:
    """Entities whose two datasets do not come in pairs with one run id and instant."""
    by_instant = runs.groupBy("source", "entity", "ingested_at").agg(
        F.count_if(F.col("dataset") == first).alias("first_runs"),
        F.count_if(F.col("dataset") == second).alias("second_runs"),
        F.count_distinct("run_id").alias("run_ids"),
    )
    return by_instant.where("first_runs != 1 OR second_runs != 1 OR run_ids != 1")
