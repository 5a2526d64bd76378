"""Relations with several consumers, computed once: written to the shared folder and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame

#: Relations stored in buckets of a key, by name.  Steps that rank, group or order their rows by
#: it, alone or with other columns, read them without a shuffle.
BUCKETED = {"fact_market_daily": "symbol"}


def kept(name: str, df: DataFrame) -> DataFrame:
    """The rows of ``df`` from a new folder below ``spark.checkpoint.dir``.

    There are as many buckets as shuffle partitions, so rows that come from a shuffle by the
    same key are written as they are.

    Without that setting a local master (tests) gets a temporary folder; any other master
    is refused, because its executors do not see the driver's disk.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    unique = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/{name}-{unique}"
    if name in BUCKETED:
        table, buckets = f"{name}_{unique}", int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartition(buckets, BUCKETED[name])
        rows.write.format("parquet").option("path", path).bucketBy(buckets, BUCKETED[name]).saveAsTable(table)
        # Columns without the table's qualifier; otherwise a union of two parts loses the buckets.
        return spark.table(table).toDF(*df.columns)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
