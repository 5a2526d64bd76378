"""Version selection: provenance join, latest row per key, newest k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import RECENCY, RUN_KEY

_RANK = "_version_rank"


def newest_first(columns: Sequence[str]) -> list[Column]:
    """Descending order.  Spelled out because engines disagree on where NULLs go."""
    return [F.col(c).desc_nulls_last() for c in columns]


def with_provenance(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Add ``ingested_at`` and ``loaded_at`` of the run each row came from.

    Rows of unregistered runs disappear.  The registry grows with the data and its files
    look a tenth as large as its rows, so an estimate would send a long one through the
    driver; it is always met by a sorted merge.  A run holding a large share of the rows
    is split by the adaptive skew join.
    """
    stamps = runs.select(*RUN_KEY, "ingested_at", "loaded_at").hint("merge")
    return rows.join(stamps, RUN_KEY, "inner")


def newest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int = 1) -> DataFrame:
    """The ``k`` newest rows per key.

    The rank filter stays next to the window, so every map task already drops all but
    its ``k`` best rows per key before the shuffle: a key with a third of all rows
    reaches its reduce task as at most ``k`` rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first(order))
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= k).drop(_RANK)


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str] = RECENCY) -> DataFrame:
    """One row per key: the most recently ingested version.  NULL keys compare equal."""
    return newest_per_group(df, keys, order, 1)


def with_arrivals(
    current: DataFrame, arrivals: DataFrame, keys: Sequence[str], order: Sequence[str] = RECENCY
) -> DataFrame:
    """``latest_version`` of everything, from the latest versions so far and newly arrived rows.

    Only keys that arrive are ranked again.  All other rows of ``current`` pass through an
    anti join with the distinct arriving keys, which adaptive execution broadcasts while
    they are few, so a small batch does not shuffle the history.
    """
    arriving = arrivals.select(*[F.col(c).alias(f"_{c}") for c in keys]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    untouched = current.join(arriving, same, "left_anti")
    touched = current.join(arriving, same, "left_semi")
    return untouched.unionByName(latest_version(touched.unionByName(arrivals.select(*current.columns)), keys, order))


def numbered_oldest_first(df: DataFrame, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """Number the rows of each key from its earliest, starting at 1."""
    window = Window.partitionBy(*keys).orderBy(F.col(order).asc())
    return df.withColumn(name, F.row_number().over(window))
