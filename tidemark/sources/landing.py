"""Landing zone: provider payloads exactly as received, one per run.

Payloads live either as one JSON file per run (the layout in ``layout``) or, for bulk
loads, as rows of a Parquet table partitioned by source, dataset and ingestion date.
Both read into the same frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators.payloads import is_single_value, strict_json
from tidemark.schemas import LANDING_SCHEMA, RUN_KEY, require_schema
from tidemark.sources.layout import RAW_NAME


class RunExists(ValueError):
    """A payload was written for a run that already has one."""


def read_payload_files(spark: SparkSession, root: str, source: str, dataset: str) -> DataFrame:
    """Payload files of one dataset.  Filters on ``ingestion_date`` and ``run_id`` prune."""
    base = f"{root.rstrip('/')}/{source}/{dataset}"
    files = (
        spark.read.schema("value string, ingestion_date date, run_id string")
        .option("basePath", base)
        .option("pathGlobFilter", f"{{{RAW_NAME},*.txt}}")
        .text(base, wholetext=True)
    )
    run = F.col("run_id")
    return files.select(
        F.lit(source).alias("source"),
        F.lit(dataset).alias("dataset"),
        "ingestion_date",
        "run_id",
        text.run_entity(run).alias("entity"),
        text.run_instant(run).alias("ingested_at"),
        F.col("value").alias("payload"),
    )


def write_payload_files(
    payloads: DataFrame, root: str, source: str, dataset: str, *, existing: DataFrame | None
) -> None:
    """Payloads of one dataset as one file per run in its run directory.

    ``existing`` has the payloads already there (None for a new root).  For feeds with few,
    large payloads.  Many small ones belong into the payload table:
    a directory per run makes every later listing as long as the history.
    """
    mine = payloads.where((F.col("source") == source) & (F.col("dataset") == dataset))
    _refuse_existing(mine, existing)
    keys = ["ingestion_date", "run_id"]
    mine.select(*keys, "payload").hint("rebalance", *keys).write.mode("append").partitionBy(*keys).text(
        f"{root.rstrip('/')}/{source}/{dataset}"
    )


def read_payload_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING_SCHEMA).parquet(path)


def append_payloads(payloads: DataFrame, path: str) -> None:
    """Append payload rows; a run that already has a payload is never overwritten.

    Only the run keys of both sides are compared, in the partitions of the new payloads.  The rebalance hint lets adaptive
    execution size the files: small partitions are merged and a partition that holds
    most of the bytes is split over several tasks.
    """
    payloads = require_schema(payloads.select(*LANDING_SCHEMA.names), LANDING_SCHEMA, what="landing")
    keys = ["source", "dataset", "ingestion_date"]
    spark = payloads.sparkSession
    # An empty append creates the folder, so that the first load is like any other.
    spark.createDataFrame([], LANDING_SCHEMA).write.mode("append").partitionBy(*keys).parquet(path)
    days = payloads.select(*keys).distinct()
    _refuse_existing(payloads, read_payload_table(spark, path).join(days, keys, "left_semi"))
    payloads.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).parquet(path)


def _refuse_existing(payloads: DataFrame, existing: DataFrame | None) -> None:
    problems = duplicate_runs(payloads)
    if existing is not None:
        problems = problems.unionByName(
            payloads.select(*RUN_KEY).join(existing.select(*RUN_KEY), RUN_KEY, "left_semi").distinct()
        )
    clash = problems.head()
    if clash is not None:
        raise RunExists(f"run {clash.source}/{clash.dataset}/{clash.run_id} has a payload already")


def duplicate_runs(payloads: DataFrame) -> DataFrame:
    """Runs with more than one payload in the batch."""
    return payloads.groupBy(*RUN_KEY).count().where("count > 1").select(*RUN_KEY)


def with_run_identity(requests: DataFrame, keys: Sequence[str] = ("source", "dataset")) -> DataFrame:
    """Derive run id and ingestion date from ``ingested_at`` and ``entity``."""
    return requests.select(
        *keys,
        F.col("ingested_at").cast("date").alias("ingestion_date"),
        text.run_id(F.col("ingested_at"), F.col("entity")).alias("run_id"),
        "entity",
        "ingested_at",
        "payload",
    )


def strict_payloads(landing: DataFrame) -> DataFrame:
    """Payload scan with a reason for every payload that is not a strict JSON object."""
    strict = strict_json(F.col("payload"))
    is_object = F.col("payload").rlike(r"^\s*\{")
    reason = F.when(~is_single_value(strict), "payload is not strict JSON").when(
        ~is_object, "payload must be an object"
    )
    return landing.withColumn("reason", reason)
