"""Shards of near equal size by histogram sort.

Rows are ordered by an integer key and, within equal keys, by the row number they got when
they were written to the shared folder.  The splitters between shards are found without
sorting: each round counts exactly, over all partitions, the bytes that lie below evenly
spaced probes inside the intervals that still hold a splitter, keeps the interval of each
splitter's target, and probes that one in the next round.  An interval that is down to one
key is probed by row number, so a key that holds a third of all rows is split like others.
One job counts for all intervals of a round, whether they hold keys or rows of a key, so the
number of jobs follows the width of the keys and not the number of splitters.  Rounds end
when every interval is within the tolerance or holds a single row.  Rows are then exchanged
once, by the splitters, and sorted where they arrive.

Law ``bytes``: a row whose predecessors have b of B bytes is in shard floor(b * shards / B).
With tolerance 0 that is exact, so shards differ by less than the largest row.

Shards too large for a task are cut into cells by the same splitters; slots run through the
cells of a shard.  Only DataFrame functions are used.  What reaches the driver is one row per
probe and one per cell: a cell holds ``cell_bytes``, so 100 TB make 400 thousand cells, and
the probes of a round share ``most_bins`` (at least two for each interval).

Edge cases: null keys come first; null sizes count as zero; repeated rows are told apart by
row number; an empty table gives an empty table; input columns named like a result column
are replaced by the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, stored, with_result

LOWEST = -(2**63)


@dataclass(frozen=True)
class ShardRules:
    shards: int = 40
    tolerance: int = 0
    probes: int = 512
    cell_bytes: int = 256 << 20
    most_bins: int = 1 << 20


PRODUCTION = ShardRules()


@dataclass(frozen=True)
class Interval:
    """Where a splitter lies: keys lo..hi, or rows lo..hi of one key; bytes before and in it."""

    key: int | None
    lo: int
    hi: int
    below: int
    size: int
    rows: int

    @property
    def start(self) -> tuple[int, int]:
        return (self.lo, LOWEST) if self.key is None else (self.key, self.lo)


def _literal(values: list[int]) -> Column:
    # One text for all values: the plan holds a single constant however many there are.
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _position(count: int, smaller) -> Column:
    """Number of leading places for which ``smaller(place)`` holds, by binary search."""
    steps = [1 << k for k in range(max(0, count).bit_length() - 1, -1, -1)]
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.coalesce(smaller(at + step - 1), F.lit(False)), at + step).otherwise(at),
    )


def _before_row(starts: list[tuple[int, int]], or_at: bool):
    """Whether the start at a place lies before (or at) the row."""
    keys, rows = _literal([k for k, _ in starts]), _literal([r for _, r in starts])

    def smaller(place: Column) -> Column:
        key, row = F.get(keys, place), F.get(rows, place)
        within = (row <= F.col("seq")) if or_at else (row < F.col("seq"))
        return (key < F.col("key")) | ((key == F.col("key")) & within)

    return smaller


def _probe(rows: DataFrame, intervals: set[Interval], rules: ShardRules) -> dict[Interval, list]:
    """Filled bins of each interval in order: (lowest value, highest value, bytes, rows)."""
    spans = sorted(intervals, key=lambda x: x.start)
    probes = max(2, min(rules.probes, rules.most_bins // len(spans)))
    lows = _literal([x.lo for x in spans])
    highs = _literal([x.hi for x in spans])
    widths = _literal([-(-(x.hi - x.lo + 1) // probes) for x in spans])
    # The key that an interval of rows belongs to; the row's own key decides in the others.
    by_row = _literal([int(x.key is not None) for x in spans])
    keys = _literal([x.lo if x.key is None else x.key for x in spans])
    at = F.col("span")
    # The lookup is projected on its own, so that it runs once per row.
    inside = (
        rows.withColumn("span", _position(len(spans), _before_row([x.start for x in spans], True)) - 1)
        .where("span >= 0")
        .withColumn("value", F.when(F.get(by_row, at) == 1, F.col("seq")).otherwise(F.col("key")))
        .where((F.col("value") <= F.get(highs, at)) & ((F.get(by_row, at) == 0) | (F.get(keys, at) == F.col("key"))))
    )
    bins = F.floor((F.col("value") - F.get(lows, at)) / F.get(widths, at))
    counted = (
        inside.groupBy("span", bins.alias("bin"))
        .agg(
            F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("size").alias("size"), F.count("*").alias("n")
        )
        .collect()
    )
    found: dict[Interval, list] = {x: [] for x in spans}
    for r in sorted(counted, key=lambda r: (r["span"], r["lo"])):
        found[spans[r["span"]]].append((r["lo"], r["hi"], r["size"], r["n"]))
    return found


def _narrowed(interval: Interval, bins: list, target: tuple[int, int]) -> Interval:
    """The bin in which the bytes reach target = (numerator, denominator)."""
    below = interval.below
    for lo, hi, size, rows in bins:
        if (below + size) * target[1] >= target[0]:
            return Interval(interval.key, lo, hi, below, size, rows)
        below += size
    raise AssertionError("the bytes of an interval do not reach its target")


def splitters(rows: DataFrame, cells: int, rules: ShardRules) -> list[tuple[int, int]]:
    """(key, row) of the last row of each cell but the last, in order; none without bytes."""
    negative = F.col("key") < 0
    facts = rows.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("total"),
        F.count("*").alias("rows"),
        F.min("key").alias("lo"),
        F.max("key").alias("hi"),
        F.max("seq").alias("last_row"),
        F.coalesce(F.sum(F.when(negative, F.col("size"))), F.lit(0)).alias("negative_total"),
        F.count(F.when(negative, 1)).alias("negative_rows"),
    ).first()
    total, last_row = facts["total"], facts["last_row"]
    targets = [(i * total, cells) for i in range(1, cells)]
    if not total:
        return []
    whole = Interval(None, facts["lo"], facts["hi"], 0, total, facts["rows"])
    halves = []
    # A span wider than a signed 64-bit difference is halved first.
    if whole.hi - whole.lo >= 2**63:
        above = (0, whole.hi, total - facts["negative_total"], whole.rows - facts["negative_rows"])
        halves = [(whole.lo, -1, facts["negative_total"], facts["negative_rows"]), above]
    found = {t: _narrowed(whole, halves, t) if halves else whole for t in targets}

    while True:
        wide = {t: x for t, x in found.items() if x.size > rules.tolerance and x.rows > 1}
        # One key left: by row number.
        for t, x in wide.items():
            if x.key is None and x.lo == x.hi:
                found[t] = wide[t] = Interval(x.lo, 0, last_row, x.below, x.size, x.rows)
        if not wide:
            break
        bins = _probe(rows, set(wide.values()), rules)
        for t, x in wide.items():
            found[t] = _narrowed(x, bins[x], t)
    return [
        (x.hi, last_row) if x.key is None else (x.key, x.hi) for x in (found[t] for t in targets)
    ]


def sharded(
    rows: DataFrame, rules: ShardRules = PRODUCTION, *, key: str = "doc_id", size: str = "size"
) -> DataFrame:
    """All columns plus shard, slot (gapless from 0 in the shard) and law."""
    row = F.col("row")
    table = stored(
        packed(rows).select(
            "row",
            F.coalesce(row.getField(key).cast("bigint"), F.lit(LOWEST)).alias("key"),
            F.coalesce(row.getField(size).cast("bigint"), F.lit(0)).alias("size"),
            F.monotonically_increasing_id().alias("seq"),
        ),
        "rows-to-shard",
    )
    narrow = table.select("key", "seq", "size")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, math.ceil(total / rules.shards / rules.cell_bytes))
    cells = rules.shards * per_shard
    ends = splitters(narrow, cells, rules)
    cell = _position(len(ends), _before_row(ends, False)) if ends else F.lit(0)
    placed = table.withColumn("cell", cell)
    counts = dict(placed.groupBy("cell").count().collect())
    offsets = [0] * cells
    for c in range(cells):
        if c % per_shard:
            offsets[c] = offsets[c - 1] + counts.get(c - 1, 0)
    in_cell = F.row_number().over(W.partitionBy("cell").orderBy("key", "seq"))
    placed = placed.withColumn("slot", F.get(_literal(offsets), F.col("cell")) + in_cell - 1)
    return with_result(
        placed,
        law=F.lit("bytes"),
        shard=F.floor(F.col("cell") / per_shard).cast("int"),
        slot=F.col("slot").cast("long"),
    )
