"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from types import ModuleType
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


T = TypeVar("T")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below ``spark.checkpoint.dir``.

    Without that setting a local master (tests) gets a temporary folder, which is then
    kept as the session's setting; any other master is refused, because its executors do
    not see the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """The frame written once to the shared folder and read back: it survives lost
    executors, its lineage is one scan, and values such as row numbers do not change.
    With ``by`` the rows lie in one folder for each value of that column."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def kept_in_worker(key: str, build: Callable[[], T]) -> T:
    """An object built once per Python worker; later tasks of the worker find it again.

    Functions of this package travel by value, so their own module globals start anew with
    each task.  The object must not hold anything that belongs to one task.
    """
    name = "tidemark_llm_kept"
    kept = sys.modules.setdefault(name, ModuleType(name)).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def packed(df: DataFrame) -> DataFrame:
    """One struct column ``row`` with all columns, so that no name of the input can clash
    with a working column; ``unpacked`` restores them."""
    return df.select(F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias("row"))


def _settled(df: DataFrame, results: dict[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """Results under names of their own, worked out before any input column gets its name
    back; otherwise an input column could take the place of a working column."""
    numbered = {name: f"result_{k}" for k, name in enumerate(results)}
    df = df.select("row", *[value.alias(numbered[name]) for name, value in results.items()])
    return df, {name: F.col(numbered[name]) for name in results}


def unpacked(df: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``row``, some with new values."""
    names = df.schema["row"].dataType.fieldNames()
    df, replaced = _settled(df, replaced)
    return df.select(
        *[(replaced[c] if c in replaced else F.col("row").getField(c)).alias(c) for c in names]
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_result(df: DataFrame, **results: Column) -> DataFrame:
    """Input columns and result columns; a result replaces an input column of its name."""
    names = [c for c in df.schema["row"].dataType.fieldNames() if c not in results]
    df, results = _settled(df, results)
    return df.select(
        *[F.col("row").getField(c).alias(c) for c in names],
        *[value.alias(name) for name, value in results.items()],
    )
