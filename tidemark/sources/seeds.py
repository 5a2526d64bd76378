"""Seed tables from CSV.  Key columns are typed, so leading zeros survive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a seed file.  The header must name the columns in order; bad rows fail."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def refresh_seed(seed: DataFrame, path: str) -> DataFrame:
    """Full refresh: the stored seed is replaced as a whole."""
    seed.write.mode("overwrite").parquet(path)
    return seed.sparkSession.read.schema(seed.schema).parquet(path)
