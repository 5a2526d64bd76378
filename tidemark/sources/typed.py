"""Typed tables: Parquet with an enforced contract, append-only.

Rows lie in one folder for each ingestion day, which is the day in the run id, and inside a file
they are ordered by run.  A load of some days only lists and reads their folders, and the files'
statistics tell runs apart.  The day is no column of the contract; readers do not see it.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CONTRACTS, INGESTION_RUNS_SCHEMA, SchemaMismatch, require_schema

#: Partition column; a file without rows in the folder of no day keeps the schema of empty tables.
DAY = "ingestion_date"
NO_DAY = f"{DAY}=__HIVE_DEFAULT_PARTITION__"

#: Folder beside the rows with the files whose schema was compared; no scan looks into it.
CHECKED = "_checked"

#: Values that no row holds, by type, as SQL.  Booleans have none and are probed with both values.
SENTINELS = {
    "string": "'no such column'",
    "integer": "-2147483648",
    "long": "-9223372036854775807L",
    "decimal": "-99999999999999999999",
    "date": "DATE'0001-01-01'",
    "timestamp": "TIMESTAMP'0001-01-01 00:00:00'",
}


def ingestion_day(run_id: str = "run_id") -> Column:
    """Day of a run; run ids begin with their instant."""
    return F.try_to_date(F.substring(run_id, 1, 8), "yyyyMMdd")


def days_of(between: tuple[str | None, str | None]) -> tuple[date | None, date | None]:
    """First and last ingestion day of a range of run ids; None where an id names no day."""

    def day(run_id: str | None) -> date | None:
        try:
            return date(int(run_id[:4]), int(run_id[4:6]), int(run_id[6:8]))
        except (TypeError, ValueError):
            return None

    return day(between[0]), day(between[1])


def read_table(
    spark: SparkSession,
    path: str,
    contract: T.StructType,
    days: tuple[date | None, date | None] | None = None,
) -> DataFrame:
    """Scan a stored table after comparing the schema in its files with the contract.

    ``days`` are the first and last ingestion day to read; folders of other days are skipped.
    None in the pair means that the bound is not known, and nothing is skipped.

    Reading with the contract alone would hide a column that is missing from a file (it
    would read as NULL), so ``check_new_files`` comes first.
    """
    check_new_files(spark, path, contract)
    stored = spark.read.schema(contract).parquet(path)
    if DAY in stored.columns and DAY not in contract.names:
        if days is not None and None not in days:
            stored = stored.where(F.col(DAY).between(F.lit(days[0]), F.lit(days[1])))
        stored = stored.drop(DAY)
    return require_schema(stored, contract, what=path)


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """Files of a table: file, size and time of change; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).select(F.col("path").alias("file"), "length", "modificationTime")


def check_new_files(spark: SparkSession, path: str, contract: T.StructType) -> int:
    """Compare the schema in the files of a table with the contract, each file once.

    Files that agree are listed in a small table beside the rows, so a later read opens none of
    their footers; one that changes counts as new.  Raises for columns that are missing from
    any single file, are typed differently or do not belong to the contract.  Returns how many files were new.  Only their names reach the driver.
    """
    path = path.rstrip("/")
    seen = T.StructType().add("file", "string").add("length", "long").add("modificationTime", "timestamp")
    known = spark.createDataFrame([], seen)
    if _exists(spark, f"{path}/{CHECKED}"):
        known = spark.read.schema(seen).parquet(f"{path}/{CHECKED}")
    files = files_of(spark, path)
    new = files.join(known, seen.names, "left_anti").collect()
    names = [r.file for r in new]
    if not names:
        if files.isEmpty():
            raise SchemaMismatch(f"{path}: no files")
        return 0
    try:
        merged = _flat(spark).option("mergeSchema", "true").parquet(*names)
    except (PySparkException, Py4JJavaError) as differing:
        if "CANNOT_MERGE" not in str(differing):
            raise
        raise SchemaMismatch(f"{path}: new files differ in their types") from differing
    present = T.StructType([f for f in contract.fields if f.name in merged.columns])
    in_order = merged.select(*_in_contract_order(merged, contract))
    require_schema(in_order, present, what=path)
    broken = incomplete_files(spark, names, contract).head()
    if broken is not None:
        raise SchemaMismatch(f"{path}: {broken.file} has no column {broken.column}")
    require_schema(in_order, contract, what=path)
    spark.createDataFrame(new, seen).coalesce(1).write.mode("append").parquet(f"{path}/{CHECKED}")
    return len(names)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _flat(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", "true")


def incomplete_files(spark: SparkSession, paths: str | list[str], contract: T.StructType) -> DataFrame:
    """Files without a column of the contract: file and column.

    A scan fills a column that a file lacks with the column's default.  The probe reads the
    table with a default that no row holds, so every hit names an incomplete file; files
    that have the column are skipped by their statistics.  A boolean column is read twice: only
    a file without it has true rows where the default is true and none where it is false.
    Files without rows hide nothing and are not found.
    """
    paths = [paths] if isinstance(paths, str) else paths

    def hits(defaults: dict[str, str]) -> DataFrame:
        fields = [
            T.StructField(f.name, f.dataType, True, {"EXISTS_DEFAULT": defaults[f.name]})
            for f in contract.fields
            if f.name in defaults
        ]
        probe = _flat(spark).schema(T.StructType(fields)).parquet(*paths)
        looked_for = {f.name: "true" if f.dataType == T.BooleanType() else defaults[f.name] for f in fields}
        hit = {f.name: F.col(f"`{f.name}`") == F.expr(looked_for[f.name]).cast(f.dataType) for f in fields}
        lacking = F.array_compact(F.array(*[F.when(found, F.lit(name)) for name, found in hit.items()]))
        rows = probe.where(reduce(lambda a, b: a | b, hit.values()))
        return rows.select(F.input_file_name().alias("file"), F.explode(lacking).alias("column")).distinct()

    sentinels = {f.name: SENTINELS[f.dataType.typeName()] for f in contract.fields if f.dataType.typeName() in SENTINELS}
    flags = [f.name for f in contract.fields if f.dataType == T.BooleanType()]
    found = spark.createDataFrame([], "file string, column string")
    if sentinels:
        found = found.unionByName(hits(sentinels))
    if flags:
        found = found.unionByName(hits(dict.fromkeys(flags, "true")).exceptAll(hits(dict.fromkeys(flags, "false"))))
    return found


def files_without_a_day(spark: SparkSession, path: str) -> DataFrame:
    """Files beside the day folders of a table, which a scan of the table would pass over."""
    return files_of(spark, path).select("file").where(~F.col("file").contains(f"/{DAY}="))


def require_whole_files(spark: SparkSession, root: str) -> None:
    """Refuse source tables with a file that lacks a column of its contract or lies in no day."""
    for name, schema in _source_schemas().items():
        path = f"{root.rstrip('/')}/{name}"
        check_new_files(spark, path, schema)
        stray = files_without_a_day(spark, path).head()
        if stray is not None:
            raise SchemaMismatch(f"{path}: {stray.file} lies outside the day folders")


def _in_contract_order(stored: DataFrame, contract: T.StructType) -> list[str]:
    # Partition columns come last in a scan; the order of the others is kept.
    known = [c for c in contract.names if c in stored.columns]
    return known + [c for c in stored.columns if c not in contract.names]


def write_new(df: DataFrame, path: str, contract: T.StructType) -> None:
    """Exclusive create.  Refuses an existing target and a frame without columns."""
    if not contract.fields:
        raise ValueError("a table needs at least one column")
    require_schema(df, contract, what=path).write.mode("errorifexists").option(
        "compression", "snappy"
    ).parquet(path)


def by_day(df: DataFrame) -> DataFrame:
    """Rows with their day, the rows of a run next to each other.

    The rebalance hint lets adaptive execution merge days with few rows and split a day that
    holds most of them.
    """
    order = [c for c in ("source", "dataset", "run_id", "source_row_number") if c in df.columns]
    return df.withColumn(DAY, ingestion_day()).hint("rebalance", DAY).sortWithinPartitions(DAY, *order)


def append_rows(df: DataFrame, path: str, contract: T.StructType) -> None:
    """Append rows with their lineage columns; only the folders of their days get new files."""
    by_day(require_schema(df, contract, what=path)).write.mode("append").partitionBy(DAY).option(
        "compression", "snappy"
    ).parquet(path)


def replace_days(df: DataFrame, path: str, contract: T.StructType) -> None:
    """Put these rows in place of all rows of their days; other days stay as they are."""
    by_day(require_schema(df, contract, what=path)).write.mode("overwrite").partitionBy(DAY).option(
        "partitionOverwriteMode", "dynamic"
    ).option("compression", "snappy").parquet(path)


def _source_schemas() -> dict[str, T.StructType]:
    return {"ingestion_runs": INGESTION_RUNS_SCHEMA, **{c.name: c.schema for c in CONTRACTS.values()}}


def create_source_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Create the six empty source tables where they are missing; returns their paths."""
    schemas = _source_schemas()
    paths = {name: f"{root.rstrip('/')}/{name}" for name in schemas}
    for name, schema in schemas.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{paths[name]}/{NO_DAY}")
    return paths


def read_source_tables(
    spark: SparkSession, root: str, days: tuple[date | None, date | None] | None = None
) -> dict[str, DataFrame]:
    return {
        name: read_table(spark, f"{root.rstrip('/')}/{name}", schema, days)
        for name, schema in _source_schemas().items()
    }
