"""Small relational helpers shared by the operators and plans."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[Sequence[object]], schema: T.StructType) -> DataFrame:
    """A short list of rows whose size the optimizer knows.

    A list given to ``createDataFrame`` directly becomes an RDD of unknown size, which is
    never broadcast: joining it would shuffle the large side on a handful of keys.
    """
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(schema.fields)}
    return spark.createDataFrame(pa.table(columns), schema)


def measured(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle a derived frame by its join keys so adaptive execution knows its size.

    Plan-time estimates do not see how far an ``explode`` fans out, so the optimizer
    could broadcast a frame that has become large.  Behind this exchange the decision
    uses the bytes really written: below the broadcast threshold the other side keeps
    its partitioning, above it the join sorts and merges and skewed keys are split.
    """
    return df.repartition(*keys)


def differs(left: Column, right: Column) -> Column:
    """``IS DISTINCT FROM``: never NULL."""
    return ~left.eqNullSafe(right)


def in_tuples(df: DataFrame, columns: Sequence[str], tuples: Sequence[Sequence[object]]) -> DataFrame:
    """Rows whose ``columns`` equal one of the literal ``tuples``."""
    wanted = [F.struct(*[F.lit(v) for v in values]) for values in tuples]
    return df.where(F.struct(*[F.col(c) for c in columns]).isin(wanted))


def latest_dates(df: DataFrame, entity: str, day: str) -> DataFrame:
    """Latest date of every entity in one aggregation."""
    return df.groupBy(entity).agg(F.max(day).alias("latest_date"))


def set_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples of ``left`` that ``right`` does not have (``EXCEPT``)."""
    return left.select(*keys).subtract(right.select(*keys))


def outside_tuples(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner in ``right`` (``NOT EXISTS``)."""
    return left.join(right.select(*keys), list(keys), "left_anti")
