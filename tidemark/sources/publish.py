"""Published relations: stored marts, report extracts, JSON reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import metric_short_name
from tidemark.sources.warehouse import Warehouse


def store(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a stored relation and return a frame that reads the stored files."""
    writer = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A published relation of a warehouse (its last version), or a plain stored table."""
    root, _, name = path.rstrip("/").rpartition("/")
    warehouse = Warehouse(spark, root)
    version = warehouse.current()
    if name in version.relations:
        return warehouse.read(version, name)
    return spark.read.parquet(path)


def report_extract(mart: DataFrame) -> DataFrame:
    """The mart as the report imports it: decimals as doubles, a metric label if it has metrics."""
    columns = [
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in mart.schema.fields
    ]
    extract = mart.select(*columns)
    if "metric_name" in mart.columns:
        extract = extract.withColumn("metric_short_name", metric_short_name(F.col("metric_name")))
    return extract


def iso(value: Column, data_type: T.DataType) -> Column:
    """Dates and instants as ISO text; other values unchanged."""
    if isinstance(data_type, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ssXXX")
    if isinstance(data_type, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    return value


def as_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON object; NULL fields are written out."""
    fields = [iso(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(name))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Name and row count of every table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table"), "row_count") for n, df in tables.items()]
    merged = counts[0]
    for more in counts[1:]:
        merged = merged.unionByName(more)
    return merged
