import zlib
from collections import defaultdict

import pytest
from helpers import nothing
from pyspark.sql import functions as F

from tidemark.llm.histogram_shards import ShardRules, sharded
from tidemark.llm.queries import op4_histogram_sort_shards


def expected(sizes, shards):
    """Shard of each row in order: its predecessors' share of all bytes."""
    total, below, out = sum(sizes), 0, []
    for s in sizes:
        out.append(below * shards // total)
        below += s
    return out


def check(rows, shards, key="doc_id"):
    rows = sorted(rows, key=lambda r: (r.shard, r.slot))
    keys = [(r[key] is not None, r[key]) for r in rows]
    assert keys == sorted(keys)
    assert [r.shard for r in rows] == expected([r["size"] or 0 for r in rows], shards)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(v == list(range(len(v))) for v in slots.values())


def test_registered_query_on_the_sample(spark):
    sf = "/root/testdata/sf0.001"
    rows = op4_histogram_sort_shards(spark, sf).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    check(rows, 40)


@pytest.mark.parametrize("probes", [3, 64])
@pytest.mark.parametrize("cell_bytes", [50, 1 << 30])
def test_hot_keys_nulls_and_repeats_are_split(spark, probes, cell_bytes):
    data = [(None, 7)] * 5 + [(13, 11)] * 120 + [(13, None)] * 3 + [(-(2**62), 5), (2**62, 9)] + [(k * 1000, 3 + k % 4) for k in range(90)]
    rows = spark.createDataFrame(data, "doc_id bigint, size bigint").repartition(5)
    got = sharded(rows, ShardRules(shards=7, probes=probes, cell_bytes=cell_bytes)).collect()
    assert len(got) == len(data)
    check(got, 7)


def test_jobs_do_not_grow_with_the_cells(spark):
    rows = spark.range(4000).select((F.col("id") * 977 % 3989).alias("doc_id"), (F.col("id") % 9 + 1).alias("size"))
    context, jobs = spark.sparkContext, []
    for cells in (5, 160):
        context.setJobGroup(f"shards-{cells}", "histogram sort")
        check(sharded(rows, ShardRules(shards=cells)).collect(), cells)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"shards-{cells}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 2


def test_few_bins_a_round_give_the_same_shards(spark):
    data = [(13, 11)] * 120 + [(k * k, 3 + k % 4) for k in range(90)]
    rows = spark.createDataFrame(data, "doc_id bigint, size bigint").repartition(4)
    check(sharded(rows, ShardRules(shards=30, most_bins=8)).collect(), 30)


def test_tolerance_bounds_the_error(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 + 1).alias("size"))
    got = sharded(rows, ShardRules(shards=10, tolerance=400, probes=8)).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    total = sum(r.b for r in got)
    assert len(got) == 10 and all(abs(r.b - total / 10) <= 2 * 400 + 50 for r in got)


def test_empty_table_and_clashing_columns(spark):
    assert sharded(nothing(spark, "doc_id bigint, size bigint")).count() == 0
    rows = spark.createDataFrame([(1, 5, "a", "b", "c"), (2, 5, "a", "b", "c")], "doc_id bigint, size bigint, cell string, seq string, row string")
    got = sharded(rows, ShardRules(shards=2)).collect()
    assert {(r.doc_id, r.shard, r.cell, r.seq, r.row) for r in got} == {(1, 0, "a", "b", "c"), (2, 1, "a", "b", "c")}


def test_fewer_rows_than_shards_and_zero_bytes(spark):
    check(sharded(spark.createDataFrame([(1, 4), (2, 4), (3, 4)], "doc_id bigint, size bigint")).collect(), 40)
    zero = sharded(spark.createDataFrame([(1, 0), (2, None)], "doc_id bigint, size bigint")).collect()
    assert {(r.shard, r.slot) for r in zero} == {(0, 0), (0, 1)}
