"""Jaccard self-join of documents on word shingles by chosen paths.

Every document is a set of word shingles.  A run sends the sets down a tree: at each node
the sets are split on a token sampled from each set with shared randomness (the shingle of
smallest hash under the node's random order, so two sets take the same branch with
probability equal to their similarity).  Nodes of at most ``bucket`` sets are compared by
brute force; larger ones split on, except where one branch keeps at least half of the sets:
those are groups of near copies, which no token separates, and they are compared in blocks
of ``bucket`` sets against each other.

A pair of similarity s that a run follows to depth d meets with probability s**d.  Runs are
repeated until each document's chance to miss a partner at the threshold, the product of
1 - threshold**depth over its runs, is at most 1 - recall.  The depth of a run is that of
the end node, also where the document became alone.  Documents in shallow nodes stop after
the first runs; only the others go on.

Equal sets are one record.  A pair counts in the first run in which it meets, so no list of
pairs has to be made distinct, and pairs never leave the task that finds them: a task gives
the number of links of each record and a link to the smallest record of its local component.
Connected components over these links are the classes.  A sketch of 128 bits per set decides
which nodes need the sets at all; with its cut six standard deviations below the expected
agreement at the threshold, it loses one pair in a billion.  Links themselves are decided on
whole sets.

Edge cases: words are runs of non-blank characters; a text with fewer words than a shingle
has one shingle of all its words; null and blank texts have none, stay alone and have no
links.  Repeated rows are copies.  Null identifiers take part like others.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.shared import packed, stored, text_or_empty, unpacked

SPLIT = re.compile(r"[\x20\x09-\x0D]+")


@dataclass(frozen=True)
class PathRules:
    words: int = 5
    threshold: float = 0.8
    recall: float = 1 - 1e-6
    bucket: int = 128
    depth: int = 4
    seed: int = 20240229
    sketch_bits: int = 128

    @property
    def first_runs(self) -> int:
        return self.runs_at(1)

    def runs_at(self, depth: int) -> int:
        """Runs after which a pair at the threshold is found if all its nodes are this deep."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**depth))

    @property
    def all_runs(self) -> int:
        return self.runs_at(self.depth)

    @property
    def most_differing(self) -> int:
        agree = (1 + self.threshold) / 2
        spread = math.sqrt(self.sketch_bits * agree * (1 - agree))
        return math.ceil(self.sketch_bits * (1 - agree) + 6 * spread)


PRODUCTION = PathRules()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of a text; keeps hashes of words it has seen."""

    def __init__(self, words: int) -> None:
        self.words, self.seen = words, {}

    def __call__(self, text: str) -> np.ndarray:
        import xxhash

        seen = self.seen
        if len(seen) > 500_000:
            seen.clear()
        hashes = []
        for w in SPLIT.split(text):
            if w:
                h = seen.get(w)
                if h is None:
                    h = seen[w] = xxhash.xxh64_intdigest(w)
                hashes.append(h)
        if not hashes:
            return np.empty(0, np.uint64)
        n = max(1, len(hashes) - self.words + 1)
        each = np.array(hashes, np.uint64)
        mixed = np.zeros(n, np.uint64)
        for k in range(min(self.words, len(hashes))):
            mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n])
        return np.unique(mixed)


def _signer(rules: PathRules):
    """UDF: text -> digest of the set, its size, sampled tokens, sketch."""
    n_tokens = rules.all_runs * rules.depth
    schema = "digest binary, size int, tokens array<int>, s0 bigint, s1 bigint"

    @F.pandas_udf(schema)
    def sign(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(rules.seed)
        samples = max(n_tokens, rules.sketch_bits)
        odd = rng.integers(0, 2**63, samples, np.uint64) * np.uint64(2) + np.uint64(1)
        shift = rng.integers(0, 2**63, samples, np.uint64)
        bit_odd = rng.integers(0, 2**63, rules.sketch_bits, np.uint64) * np.uint64(2) + np.uint64(1)
        shingles = Shingler(rules.words)
        for batch in texts:
            out = []
            for text in batch:
                s = shingles(text or "")
                if not len(s):
                    out.append((None, 0, None, 0, 0))
                    continue
                low = np.full(samples, np.iinfo(np.uint64).max, np.uint64)
                for part in np.array_split(s, len(s) // 2048 + 1):
                    # Multiplication alone keeps some order between sets; the shift before
                    # it makes the orders of the samples independent.
                    low = np.minimum(low, ((part[:, None] ^ shift) * odd).min(axis=0))
                mixed = _mixed(low)
                tokens = (mixed[:n_tokens] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                # Sketch bits come from the same samples, each mixed with a constant.
                bits = (_mixed(mixed[: rules.sketch_bits] ^ bit_odd) >> np.uint64(63)).astype(np.uint8)
                sketch = np.packbits(bits).view(np.int64)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                out.append((digest, len(s), tokens.tolist(), int(sketch[0]), int(sketch[1])))
            yield pd.DataFrame(out, columns=["digest", "size", "tokens", "s0", "s1"])

    return sign


def _nodes(records: DataFrame, first: int, last: int, rules: PathRules) -> tuple[DataFrame, DataFrame]:
    """End nodes of runs first <= run < last.

    The first frame has the shared ones: rec, run, node, size, depth and sketch.  The second
    has rec and depth of records that became alone below the first token; of those alone at
    depth 1 there is no row.
    """
    d = rules.depth
    starts = F.transform(
        F.sequence(F.lit(first), F.lit(last - 1)),
        lambda r: F.struct(r.alias("run"), F.slice("tokens", r * d + 1, F.lit(d)).alias("path")),
    )
    at = records.select("rec", "s0", "s1", "copies", F.inline(starts)).select(
        "rec", "s0", "s1", "copies", "run", "path",
        F.xxhash64("run", F.get("path", F.lit(0))).alias("node"),
    )
    ends, alone = [], [records.select("rec", F.lit(1).alias("depth")).limit(0)]
    for depth in range(1, d + 1):
        sizes = at.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
        if depth == 1:
            at = at.join(sizes.where("size > 1"), "node")
        else:
            at = at.join(sizes, "node").withColumn("path", F.when(F.col("size") > 1, F.col("path")))
        at = stored(at, f"path-nodes-{depth}")
        if depth > 1:
            alone.append(at.where("size = 1").select("rec", F.lit(depth).alias("depth")))
            at = at.where("size > 1")
        small = at.where(F.col("size") <= rules.bucket)
        ends.append(small.withColumn("depth", F.lit(depth)))
        large = at.where(F.col("size") > rules.bucket)
        if large.isEmpty():
            break
        if depth == d:
            ends.append(large.withColumn("depth", F.lit(depth)))
            break
        below = large.withColumn("child", F.xxhash64("node", F.get("path", F.lit(depth))))
        children = below.groupBy("node", "child").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
        alike = children.groupBy("node").agg((F.max("n") * 2 >= F.max("size")).alias("alike"))
        below = stored(below.join(alike, "node"), f"path-split-{depth}")
        ends.append(below.where("alike").drop("child", "alike").withColumn("depth", F.lit(depth)))
        at = below.where("NOT alike").drop("node", "size", "alike").withColumnRenamed("child", "node")
    return reduce(DataFrame.unionByName, [e.drop("path") for e in ends]), reduce(DataFrame.unionByName, alone)


def _unsettled(ends: DataFrame, alone: DataFrame, rules: PathRules) -> DataFrame:
    """rec of the records whose chance to miss a partner in the first runs is too high."""
    missing = F.exp(F.sum(F.log(1 - F.pow(F.lit(rules.threshold), F.col("depth")))))
    return (
        ends.select("rec", "depth")
        .unionByName(alone)
        .groupBy("rec")
        .agg(missing.alias("missed"), F.count(F.lit(1)).alias("runs"))
        # Runs without a row are those in which the record is alone at depth 1.
        .withColumn(
            "missed",
            F.col("missed") * F.pow(F.lit(1 - rules.threshold), F.lit(rules.first_runs) - F.col("runs")),
        )
        .where(F.col("missed") > 1 - rules.recall + 1e-15)
        .select("rec")
    )


def _pairs(group: np.ndarray, side: np.ndarray, run: np.ndarray, s0, s1, leaves: np.ndarray, most: int):
    """Index pairs that share a group, may be similar and did not meet in an earlier run.

    ``group`` is sorted, so partners lie at growing distances; all groups advance together.
    """
    # bitwise_count() takes absolute values of signed numbers.
    s0, s1 = s0.view(np.uint64), s1.view(np.uint64)
    found = []
    for lag in range(1, len(group)):
        same = group[:-lag] == group[lag:]
        if not same.any():
            break
        i = np.flatnonzero(same)
        j = i + lag
        i, j = (k[(side[i] < 0) | (side[i] != side[j])] for k in (i, j))
        differing = np.bitwise_count(s0[i] ^ s0[j]).astype(np.int64) + np.bitwise_count(s1[i] ^ s1[j])
        near = differing <= most
        i, j = i[near], j[near]
        if len(i):
            before = np.arange(leaves.shape[1])[None, :] < run[i][:, None]
            met = ((leaves[i] == leaves[j]) & (leaves[i] != 0) & before).any(axis=1)
            found.append(np.stack([i[~met], j[~met]]))
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by group, cut only between groups."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        group = batch["grp"].to_numpy()
        cut = np.searchsorted(group, group[-1])
        rest = batch.iloc[cut:]
        if cut:
            yield batch.iloc[:cut].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def _candidates_of(batch: pd.DataFrame, most: int) -> np.ndarray:
    leaves = np.stack(batch["leaves"].to_numpy())
    columns = (batch[c].to_numpy() for c in ("grp", "side", "run", "s0", "s1"))
    return _pairs(*columns, leaves, most)


def _local_roots(i: np.ndarray, j: np.ndarray, rec: np.ndarray) -> np.ndarray:
    """Smallest record of each row's component under the given links."""
    root = rec.copy()
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        if (least == root).all():
            return root
        root = least


LINK_SCHEMA = "rec bigint, texts bigint, docs bigint, root bigint"


def _links(groups: DataFrame, texts: DataFrame, rules: PathRules) -> DataFrame:
    """rec, texts, docs, root: links counted in one group, and the local component."""
    most, words, threshold = rules.most_differing, rules.words, rules.threshold
    schema = groups.schema

    def only_candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _whole_groups(batches):
            yield batch.iloc[np.unique(_candidates_of(batch, most))]

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(words)
        for batch in _whole_groups(batches):
            i, j = _candidates_of(batch, most)
            sets = [shingles(t) for t in batch["text"]]
            linked = np.zeros(len(i), bool)
            order = np.argsort(i, kind="stable")
            for k in np.split(order, np.flatnonzero(np.diff(i[order])) + 1):
                if not len(k):
                    continue
                mine = sets[i[k[0]]]
                for p in k:
                    other = sets[j[p]]
                    place = np.searchsorted(mine, other)
                    place[place == len(mine)] = 0
                    both = int((mine[place] == other).sum())
                    linked[p] = both >= threshold * (len(mine) + len(other) - both) - 1e-9
            i, j = i[linked], j[linked]
            rec, copies = batch["rec"].to_numpy(), batch["copies"].to_numpy()
            n, docs = np.zeros(len(rec), np.int64), np.zeros(len(rec), np.int64)
            for a, b in ((i, j), (j, i)):
                np.add.at(n, a, 1)
                np.add.at(docs, a, copies[b])
            out = pd.DataFrame({"rec": rec, "texts": n, "docs": docs, "root": _local_roots(i, j, rec)})
            yield out[out["texts"] > 0]

    sorted_groups = groups.repartition("grp").sortWithinPartitions("grp")
    flagged = stored(sorted_groups.mapInPandas(only_candidates, schema), "path-candidates")
    with_text = flagged.join(texts, "rec").repartition("grp").sortWithinPartitions("grp")
    return stored(with_text.mapInPandas(exact, LINK_SCHEMA), "path-links")


def _groups(ends: DataFrame, rules: PathRules) -> DataFrame:
    """End nodes as groups of at most two blocks, with the record's end nodes of all runs."""
    runs = rules.all_runs
    here = F.struct("run", "node", "size")
    by_record = ends.groupBy("rec", "s0", "s1", "copies").agg(F.collect_list(here).alias("nodes"))
    by_run = F.map_from_entries(F.transform("nodes", lambda x: F.struct(x["run"], x["node"])))
    by_record = by_record.withColumn("by_run", by_run).withColumn(
        "leaves",
        F.transform(
            F.sequence(F.lit(0), F.lit(runs - 1)),
            lambda r: F.coalesce(F.element_at("by_run", r), F.lit(0).cast("bigint")),
        ),
    )
    rows = by_record.select("rec", "s0", "s1", "copies", "leaves", F.inline("nodes"))
    blocks = F.ceil(F.col("size") / rules.bucket)
    rows = rows.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("rec", "run"), F.col("blocks"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    return rows.select(
        F.xxhash64("run", "node", F.least("block", "other"), F.greatest("block", "other")).alias("grp"),
        F.when(F.col("block") == F.col("other"), -1).otherwise((F.col("block") > F.col("other")).cast("int")).alias("side"),
        "rec", "run", "s0", "s1", "copies", "leaves",
    )


def joined(
    docs: DataFrame,
    rules: PathRules = PRODUCTION,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry_rows: bool = False,
) -> DataFrame:
    """One row per document: its identifier, class_id, n_links, n_linked_texts, class_size
    and stays (true for one row of a class).

    class_id is the smallest identifier of the class; n_links counts the other documents,
    copies included, whose similarity reaches the threshold; n_linked_texts counts sets.
    With ``carry_rows`` the columns are seq, row (a struct of all input columns) and the
    results.
    """
    row = F.col("row")
    text = text_or_empty(row.getField(text_column))
    signed = packed(docs).select(
        *(["row"] if carry_rows else [row.getField(id_column).alias("id"), text.alias("text")]),
        _signer(rules)(text).alias("sign"),
        F.monotonically_increasing_id().alias("seq"),
    )
    base = stored(signed, "signed-documents")
    if carry_rows:
        base = base.withColumn("id", row.getField(id_column)).withColumn("text", text)
    sets = base.where("sign.size > 0")
    records = stored(
        sets.groupBy("sign.digest").agg(
            F.min("seq").alias("rec"),
            F.count(F.lit(1)).alias("copies"),
            F.first("sign.tokens").alias("tokens"),
            F.first("sign.s0").alias("s0"),
            F.first("sign.s1").alias("s1"),
        ),
        "set-records",
    )
    ends, alone = _nodes(records, 0, rules.first_runs, rules)
    deep = _unsettled(ends, alone, rules)
    if rules.all_runs > rules.first_runs and not deep.isEmpty():
        going_on = records.join(deep, "rec", "left_semi")
        ends = ends.unionByName(_nodes(going_on, rules.first_runs, rules.all_runs, rules)[0])
    links = _links(_groups(ends, rules), base.select(F.col("seq").alias("rec"), "text"), rules)
    roots = connected(links.select(F.col("rec").alias("u"), F.col("root").alias("v")).where("u <> v"))

    counted = links.groupBy("rec").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    classes = (
        records.select("digest", "rec", "copies")
        .join(counted, "rec", "left")
        .join(roots.select(F.col("vertex").alias("rec"), "root"), "rec", "left")
        .select(
            "digest", F.coalesce("root", "rec").alias("class_seq"), "copies",
            F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs"),
        )
        .where("copies > 1 OR texts > 0")
    )
    narrow = base.select("id", "seq", F.col("sign.digest").alias("digest"))
    placed = narrow.join(classes, "digest", "left").withColumn("class_seq", F.coalesce("class_seq", "seq"))
    heads = (
        placed.where("copies IS NOT NULL")
        .groupBy("class_seq")
        .agg(F.min("id").alias("class_id"), F.min(F.struct("id", "seq")).alias("head"), F.count(F.lit(1)).alias("class_size"))
    )
    result = placed.join(heads, "class_seq", "left").select(
        "seq", "id",
        F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.coalesce("docs", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_linked_texts"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.col("head").isNull() | (F.col("head.seq") == F.col("seq"))).alias("stays"),
    )
    if not carry_rows:
        return result.drop("seq").withColumnRenamed("id", id_column)
    return base.select("seq", "row").join(result.drop("id"), "seq")


def one_of_each_class(docs: DataFrame, rules: PathRules = PRODUCTION, **columns: str) -> DataFrame:
    """The input without all but one document of each class."""
    return unpacked(joined(docs, rules, carry_rows=True, **columns).where("stays"))
