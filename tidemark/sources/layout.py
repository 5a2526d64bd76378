"""Run layout and manifests: which runs exist and which of their artifacts are present.

    <root>/<source>/<dataset>/ingestion_date=YYYY-MM-DD/run_id=<id>/payload.json
                                                                   /data.parquet
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators.relational import literal_table
from tidemark.schemas import DATASET_SCHEMA, DATASETS, RUN_KEY

RAW_NAME = "payload.json"
TYPED_NAME = "data.parquet"

_COMPONENT = r"^[a-z0-9]([a-z0-9_]*[a-z0-9])?\z"


def is_component(name: Column) -> Column:
    """Valid source or dataset name: lower case, digits, interior underscores."""
    return F.coalesce(name.rlike(_COMPONENT), F.lit(False))


def run_directory(root: str, source: Column, dataset: Column, ingested_at: Column, entity: Column) -> Column:
    """Canonical directory of a run."""
    return F.concat_ws(
        "/",
        F.lit(root.rstrip("/")),
        source,
        dataset,
        F.concat(F.lit("ingestion_date="), F.date_format(ingested_at, "yyyy-MM-dd")),
        F.concat(F.lit("run_id="), text.run_id(ingested_at, entity)),
    )


def manifest(artifacts: DataFrame, path: str = "path") -> DataFrame:
    """One row per run from a listing of artifact paths.

    ``artifacts`` holds one path per file; names that belong to neither artifact are
    counted as strays.  A typed artifact may be a directory of part files.
    """
    column = F.col(path)
    part = r"/([^/]+)/([^/]+)/ingestion_date=([^/]+)/run_id=([^/]+)/([^/]+)"
    pieces = {
        name: F.regexp_extract(column, part, group)
        for group, name in enumerate(("source", "dataset", "ingestion_date", "run_id", "artifact"), 1)
    }
    listed = artifacts.select(*[c.alias(n) for n, c in pieces.items()]).where(F.col("run_id") != "")
    is_raw, is_typed = F.col("artifact") == RAW_NAME, F.col("artifact") == TYPED_NAME
    runs = listed.groupBy(*RUN_KEY, "ingestion_date").agg(
        F.bool_or(is_raw).alias("raw_present"),
        F.bool_or(is_typed).alias("typed_present"),
        F.count_if(~(is_raw | is_typed)).alias("stray_count"),
    )
    return runs.select(
        *RUN_KEY,
        F.col("ingestion_date").try_cast("date").alias("ingestion_date"),
        "raw_present",
        "typed_present",
        "stray_count",
        text.run_entity(F.col("run_id")).alias("entity"),
        text.run_instant(F.col("run_id")).alias("ingested_at"),
    )


def list_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Paths below ``root``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run of every dataset and whether its artifact pair is complete.

    ``max_by`` over (date, run id) aggregates before the shuffle: nothing is ranked.
    """
    newest = F.struct("ingestion_date", "run_id")
    picked = F.struct("run_id", "raw_present", "typed_present")
    return (
        runs.groupBy("source", "dataset")
        .agg(F.max_by(picked, newest).alias("latest"), F.count("*").alias("run_count"))
        .select(
            "source",
            "dataset",
            F.col("latest.run_id").alias("latest_run_id"),
            (F.col("latest.raw_present") & F.col("latest.typed_present")).alias("latest_pair_present"),
            "run_count",
        )
    )


def dataset_inventory(runs: DataFrame) -> DataFrame:
    """``latest_runs`` against the list of known datasets; datasets without runs stay."""
    known = literal_table(runs.sparkSession, DATASETS, DATASET_SCHEMA)
    return known.join(latest_runs(runs), ["source", "dataset"], "left")
