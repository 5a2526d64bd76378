"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """vertex, root: the smallest vertex of its component, for all vertices of ``edges`` (u, v).

    Each round gives every vertex the smallest root among its neighbours and then the root
    of that root, so long chains shrink by halves.  Rounds end when nothing changes; their
    results are written to the shared folder.  Vertices with many edges meet as partial
    minima, one row per task.
    """
    both = stored(
        edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
        "component-edges",
    )
    state = both.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("v")).select(
        "vertex", F.least("vertex", "v").alias("root"), F.lit(True).alias("changed")
    )
    state = stored(state, "component-roots")
    for _ in range(rounds):
        roots = state.select(F.col("vertex").alias("v"), F.col("root").alias("near"))
        best = both.join(roots, "v").groupBy(F.col("u").alias("vertex")).agg(F.min("near").alias("near"))
        lowered = state.join(best, "vertex").select(
            "vertex", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        above = state.select(F.col("vertex").alias("root"), F.col("root").alias("above"))
        jumped = lowered.join(above, "root", "left").select(
            "vertex", F.least("root", F.coalesce("above", "root")).alias("root"), "old"
        )
        state = stored(
            jumped.select("vertex", "root", (F.col("root") < F.col("old")).alias("changed")), "component-roots"
        )
        if state.where("changed").isEmpty():
            return state.select("vertex", "root")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
