"""Bulk-synchronous best-fit packing of documents into token sequences.

Documents become token ids with an end id; longer ones than a sequence are cut, the first
piece taking the odd length.  Pieces and gaps (the room left in a sequence) are tables; every
round is one step of Spark jobs over them.  Size classes go from the longest pieces to the
shortest, so that short ones cannot take the gaps of longer ones; within a class:

* Sweep: pieces and usable gaps are range-sorted together, the largest first.  Each task goes
  down its range and puts every piece into the smallest gap that holds it, its successor.
* Conflicts: what a task leaves over, gaps and pieces, is ranked.  A running balance over the
  ranges gives each of them a level, as with brackets; the gap next before a piece on its level
  is its successor among the gaps of all earlier ranges, and no two pieces share one.
* Update: the used gaps lose the room and go into the next sweep, until a sweep places less than
  ``worthwhile`` of its pieces.  What is left is range-sorted and opens new sequences.

A gap wider than the class holds every piece of it; such gaps are spread over the ranges.  Only
totals of a round and no rows pass the driver.  One broadcast holds a row for each range.  What
fits into one range is packed by best fit decreasing in a single sweep.

Edge cases: a null text is empty and takes one token, the end id.  Very long texts become many
pieces.  Repeated rows and rows with equal or null ids are told apart by a row number and are
packed as often as they occur.  Equal lengths are ordered by row number.  An empty table gives
an empty table.  Other input columns are dropped, also those named like a result.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import kept_in_worker, packed, stored, text_or_empty


@dataclass(frozen=True)
class PackingRules:
    capacity: int = 2048
    end_id: int = 0
    #: Names of vocabulary files, looked up by ``public_tokenizers.path`` in each task, or paths.
    vocabulary: str = "byte_bpe_50k.json"
    ranks: str = "byte_bpe_50k.tiktoken"
    #: Rows of pieces and gaps that one task sorts and sweeps.
    rows_per_task: int = 50_000
    #: Share of its pieces that a sweep must place for another one to follow.
    worthwhile: float = 0.01


PRODUCTION = PackingRules()

PIECES = "array<struct<piece:int,start:bigint,length:int,crc:bigint,ids:binary>>"


def _path(name: str) -> str:
    import os

    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids as the tokenizers library gives them.

    The rank file holds the same vocabulary and is encoded four times as fast.  Its library
    splits words by the same pattern, but follows another Unicode version and leaves special
    tokens alone; texts in which that could matter go to the tokenizers library itself.
    """

    plain = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏΑ-ωА-я–-…]*")

    def __init__(self, rules: PackingRules) -> None:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(_path(rules.vocabulary))
        self.specials = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(_path(rules.ranks), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def __call__(self, text: str) -> list[int]:
        if self.plain.fullmatch(text) and not any(s in text for s in self.specials):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


def _piecewise(rules: PackingRules, with_ids: bool):
    @F.pandas_udf(PIECES)
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = kept_in_worker(f"encoder {rules.vocabulary} {rules.ranks}", lambda: Encoder(rules))
        for batch in texts:
            out = []
            for text in batch:
                ids = np.array([*encode(text or ""), rules.end_id], "<u4")
                first = (len(ids) - 1) % rules.capacity + 1
                bounds = [0, *range(first, len(ids) + 1, rules.capacity)]
                out.append(
                    [
                        (n, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].tobytes() if with_ids else None)
                        for n, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
                    ]
                )
            yield pd.Series(out)

    return cut


def pieces(docs: DataFrame, rules: PackingRules, id_column: str, text_column: str, with_ids: bool) -> DataFrame:
    """id, seq (row number), piece, start, length, crc and, if asked for, the ids."""
    row = F.col("row")
    cut = _piecewise(rules, with_ids)(text_or_empty(row.getField(text_column)))
    rows = packed(docs).select(
        row.getField(id_column).alias("id"), F.monotonically_increasing_id().alias("seq"), cut.alias("cut")
    )
    out = rows.select("id", "seq", F.inline("cut"))
    return out if with_ids else out.drop("ids")


#: Kinds of rows in a round.
GAP, WAITING, PLACED = 0, 1, 2


def classes(capacity: int) -> list[tuple[int, int]]:
    """Size classes (above, up to) from the longest pieces to the shortest."""
    bounds = [capacity, capacity // 2, capacity // 4, capacity // 16, 0]
    return [(low, high) for high, low in zip(bounds, bounds[1:], strict=False) if low < high]


def _class_of(length: Column, capacity: int) -> Column:
    at = F.lit(len(classes(capacity)) - 1)
    for k, (low, _) in reversed(list(enumerate(classes(capacity)))):
        at = F.when(length > low, k).otherwise(at)
    return at


def _filled(capacity: int, opening: bool, first_bin: int):
    """Best fit down one range of rows; ``opening`` starts a sequence where no gap fits."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        next_bin = first_bin + (part << 32)
        bins: dict[int, list[int]] = {}
        rooms: list[int] = []
        n_waiting, last, schema = 0, 0, None

        def add(room: int, number: int) -> None:
            if room not in bins:
                bisect.insort(rooms, room)
                bins[room] = []
            bins[room].append(number)

        def out(rows: pa.RecordBatch, **columns: np.ndarray) -> pa.RecordBatch:
            kept = [n for n in rows.schema.names if n not in ("kind", "bin", "room", "at")]
            types = {"kind": pa.int32(), "room": pa.int32(), "bin": pa.int64(), "rank": pa.int64()}
            values = [rows.column(n) for n in kept] + [pa.array(columns[n], t) for n, t in types.items()]
            values.append(pa.array(np.full(rows.num_rows, part), pa.int32()))
            return pa.RecordBatch.from_arrays(values, [*kept, *types, "part"])

        for batch in batches:
            schema = batch.schema
            is_piece = batch.column("kind").to_numpy() == WAITING
            result = []
            for piece, room, number, at in zip(
                is_piece.tolist(), batch.column("room").to_pylist(), batch.column("bin").to_pylist(),
                batch.column("at").to_pylist(), strict=True,
            ):
                last = at
                if not piece:
                    add(room, number)
                    continue
                k = bisect.bisect_left(rooms, at)
                if k < len(rooms):
                    gap = rooms[k]
                    taken = bins[gap].pop()
                    if not bins[gap]:
                        del bins[gap], rooms[k]
                elif opening:
                    gap, taken, next_bin = capacity, next_bin, next_bin + 1
                else:
                    result.append((WAITING, 0, 0, n_waiting))
                    n_waiting += 1
                    continue
                result.append((PLACED, capacity - gap, taken, -1))
                if gap > at:
                    add(gap - at, taken)
            kind, room, number, rank = np.array(result, np.int64).reshape(-1, 4).T
            yield out(batch.filter(pa.array(is_piece)), kind=kind, room=room, bin=number, rank=rank)
        # Later ranges hold no larger piece than the last row, so these gaps hold any of them.
        n_open = 0
        for room in reversed(rooms):
            numbers = np.array(bins[room], np.int64)
            n = len(numbers)
            rank = np.arange(n_open, n_open + n) if room >= last and not opening else np.full(n, -1)
            n_open += n
            nothing = pa.RecordBatch.from_arrays([pa.nulls(n, t) for t in schema.types], schema.names)
            yield out(nothing, kind=np.full(n, GAP), room=np.full(n, room), bin=numbers, rank=rank)

    return fill


def _round(waiting: DataFrame, gaps: DataFrame | None, rules: PackingRules, size: int, bounds: tuple[int, int], number: int) -> DataFrame:
    """One pass over the ranges: waiting pieces, placed pieces and gaps after it, with the rank
    of what a later range or an earlier one could still use.  Sequences are opened where there
    are no gaps, and where one range holds all of them, so that no other can still offer one."""
    parts = size // rules.rows_per_task + 1
    rows = waiting.select(
        "*", F.lit(WAITING).alias("kind"), F.lit(0).cast("long").alias("bin"), F.lit(0).alias("room"),
        F.col("length").alias("at"),
    )
    if gaps is not None:
        low, high = bounds
        spread = F.lit(low + 1) + F.pmod(F.xxhash64("bin"), F.lit(high - low)).cast("int")
        at = F.when(F.col("room") > high, spread).otherwise(F.col("room")) if parts > 1 else F.col("room")
        rows = rows.unionByName(
            gaps.select("bin", "room", F.lit(GAP).alias("kind"), at.alias("at")), allowMissingColumns=True
        )
    order = [F.desc("at"), F.asc("kind"), F.asc("bin"), F.asc("seq"), F.asc("piece")]
    ranges = rows.repartitionByRange(parts, *order) if parts > 1 else rows.repartition(1)
    kept = [T.StructField(f.name, f.dataType) for f in waiting.schema.fields]
    schema = T.StructType(kept).add("kind", "integer").add("room", "integer").add("bin", "long").add("rank", "long").add("part", "integer")
    fill = _filled(rules.capacity, gaps is None or parts == 1, number << 52)
    return stored(ranges.sortWithinPartitions(*order).mapInArrow(fill, schema), "packing-round")


def _without_conflicts(swept: DataFrame, capacity: int) -> DataFrame:
    """Pieces and gaps that ranges left over, matched by the level of a running balance."""
    left = swept.where("rank >= 0")
    per_range = left.groupBy("part").agg(
        F.count_if(F.col("kind") == WAITING).alias("pieces"), F.count_if(F.col("kind") == GAP).alias("gaps")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    balance = F.coalesce(F.sum(F.col("gaps") - F.col("pieces")).over(earlier), F.lit(0))
    # One row for each range, whatever the number of its rows.
    ranges = F.broadcast(per_range.select("part", "pieces", balance.alias("balance")))
    is_gap = F.col("kind") == GAP
    # In a range the pieces that found no gap precede the gaps that no piece took.
    level = F.col("balance") + F.when(is_gap, F.col("rank") + 1 - F.col("pieces")).otherwise(-F.col("rank"))
    on_level = Window.partitionBy("level").orderBy("part", F.desc("kind"))
    met = left.join(ranges, "part").withColumn("level", level).select(
        "*",
        F.lag(F.struct("kind", "bin", "room")).over(on_level).alias("gap"),
        F.lead(F.struct("kind", "length")).over(on_level).alias("taker"),
    )
    matched = ~is_gap & (F.col("gap.kind") == GAP)
    used = F.when(F.col("taker.kind") == WAITING, F.col("taker.length")).otherwise(0)
    resolved = {
        "kind": F.when(matched, PLACED).otherwise(F.col("kind")),
        "bin": F.when(matched, F.col("gap.bin")).otherwise(F.col("bin")),
        "room": F.when(matched, capacity - F.col("gap.room")).when(is_gap, F.col("room") - used).otherwise(F.col("room")),
    }
    settled = met.select(*[resolved.get(c, F.col(c)).alias(c) for c in swept.columns])
    return stored(settled.unionByName(swept.where("rank < 0")), "packing-matches")


def best_fit(table: DataFrame, rules: PackingRules) -> DataFrame:
    """Rows of ``table`` (seq, piece, length and others) with sequence_id and offset."""
    spark = table.sparkSession
    table = stored(table.withColumn("class", _class_of(F.col("length"), rules.capacity)), "pieces-by-class", by="class")
    sizes = dict(table.groupBy("class").count().collect())
    columns = [c for c in table.columns if c != "class"]
    gaps, done, number = None, [], 0
    for k, bounds in enumerate(classes(rules.capacity)):
        waiting, left = table.where(F.col("class") == k).select(*columns), sizes.get(k, 0)
        sweeping = gaps is not None
        while left:
            usable = gaps.where(F.col("room") > bounds[0]) if sweeping else None
            n_gaps = usable.count() if sweeping else 0
            sweeping = n_gaps > 0
            number += 1
            rows = _round(waiting, usable if sweeping else None, rules, left + n_gaps, bounds, number)
            kinds = rows.where("rank >= 0").agg(
                F.count_if(F.col("kind") == WAITING).alias("pieces"),
                F.count_if(F.col("kind") == GAP).alias("gaps"),
                F.count_distinct("part").alias("parts"),
            ).head()
            if kinds.pieces and kinds.gaps and kinds.parts > 1:
                rows = _without_conflicts(rows, rules.capacity)
            done.append(rows.where(F.col("kind") == PLACED))
            after = rows.where((F.col("kind") == GAP) & (F.col("room") > 0)).select("bin", "room")
            if gaps is not None:
                after = after.unionByName(gaps.where(F.col("room") <= bounds[0]) if sweeping else gaps)
            gaps = after
            waiting = rows.where(F.col("kind") == WAITING).select(*columns)
            before, left = left, waiting.count()
            sweeping = sweeping and before - left >= before * rules.worthwhile
    nothing = T.StructType([*table.select(*columns).schema.fields]).add("bin", "long").add("room", "integer")
    out = spark.createDataFrame([], nothing)
    for rows in done:
        out = out.unionByName(rows.select(*columns, "bin", "room"))
    return out.withColumnsRenamed({"bin": "sequence_id", "room": "offset"})


def packed_pieces(
    docs: DataFrame,
    rules: PackingRules = PRODUCTION,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: identifier, piece, start, length, ids_crc32, sequence_id, offset,
    and with ``with_ids`` the ids as little-endian unsigned 32-bit integers."""
    out = best_fit(pieces(docs, rules, id_column, text_column, with_ids), rules)
    return out.select(
        F.col("id").alias(id_column),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"),
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )


def sequences(docs: DataFrame, rules: PackingRules = PRODUCTION, **columns: str) -> DataFrame:
    """sequence_id, n_tokens and the token ids of every sequence, at most ``capacity`` each."""
    placed = packed_pieces(docs, rules, with_ids=True, **columns)
    ids = F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: F.hex(x["ids"])
    )
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.unhex(F.array_join(ids, "")).alias("ids")
    )
