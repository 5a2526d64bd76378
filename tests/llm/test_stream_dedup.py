from collections import defaultdict

import pytest
from helpers import awkward, nothing
from pyspark.sql import functions as F

from tidemark.llm.stream_dedup import deduplicated, distinct_documents


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows)
    got = deduplicated(docs, **options).collect()
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text or ""]
        if r.kept:
            kept[r.text or ""] += 1
            assert r.doc_id == r.keep_id
    assert dict(kept) == {t: 1 for t in want}


def test_awkward_rows(spark):
    check(awkward(spark))
    assert deduplicated(nothing(spark)).count() == 0


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_batches_do_not_change_the_result(spark, batches):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 37).cast("string")).alias("text")
    )
    check(docs.repartition(5, "doc_id"), batches=batches)


def test_full_bytes_decide_where_digests_collide(spark):
    def weak(text):
        return F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))

    docs = spark.range(60).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 11).cast("int")).alias("text")
    )
    check(docs, digest=weak)


def test_rows_that_stay_keep_their_columns(spark):
    docs = awkward(spark, clash=("kept", "keep_id", "digest", "seq"))
    got = distinct_documents(docs)
    assert got.columns == docs.columns
    assert {r.kept for r in got.collect()} == {"own kept"}
    texts = [r.text or "" for r in got.collect()]
    assert len(texts) == len(set(texts))


def test_a_later_call_meets_the_state_of_earlier_ones(spark, tmp_path):
    folder = f"file://{tmp_path}/state"
    seen = []
    for rows in ([(1, "a"), (2, "b"), (9, "c")], [(3, "a"), (4, "d"), (5, "c")], [(6, "d"), (7, None), (0, "a"), (8, "")]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        seen += rows
        want = expected(seen)
        got = deduplicated(docs, state_folder=folder).collect()
        assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
        for r in got:
            keep, size = want[r.text or ""]
            assert (r.keep_id, r.group_size, r.kept) == (keep, size, r.doc_id == keep)


def test_copies_of_a_hot_text_are_combined_before_they_are_moved(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("text"))
    got = deduplicated(docs.repartition(6)).groupBy("keep_id", "group_size").agg(F.sum(F.col("kept").cast("int")).alias("kept"))
    assert [tuple(r) for r in got.collect()] == [(2999, 3000, 1)]
