"""Every stage against brute force on its own input, and the whole run."""

import corpus_pipeline
from helpers import nothing
from test_best_fit import fits
from test_chosen_path import brute
from test_quality_lines import measures
from test_secret_scan import added, base

from tidemark.llm.shared import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    inputs = []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append([r.asDict() for r in docs.collect()])
        docs = stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == names or name == "best-fit packing"
    start, cleaned, single, apart, safe = inputs

    by_id = {r["doc_id"]: r for r in start}
    for r in start:
        n, _, _, _, repeated = measures(r["text"])
        if n < 50 or 100 * repeated > 50 * n:
            assert r["doc_id"] not in {c["doc_id"] for c in cleaned}
    for c in cleaned:
        lines = by_id[c["doc_id"]]["text"].split("\n")
        assert all(x in lines for x in c["text"].split("\n")) and c["n_chars"] == len(c["text"])

    best = {}
    for r in cleaned:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert {r["doc_id"] for r in single} == set(best.values())

    classes = {c for _, c, _ in brute([(r["doc_id"], r["text"]) for r in single])}
    assert {r["doc_id"] for r in apart} == classes

    before = {r["doc_id"]: r["text"] for r in apart}
    assert len(safe) == len(apart)
    for r in safe:
        if base(before[r["doc_id"]]) or added(before[r["doc_id"]]):
            assert not base(r["text"]) and "[SECRET]" in r["text"]
        else:
            assert r["text"] == before[r["doc_id"]]

    rows = docs.collect()
    assert {r.doc_id for r in rows} == {r["doc_id"] for r in safe}
    fits(rows, 2048)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and fits(rows, 2048) < len(rows)


LONG = " ".join(f"The river{k} and hill{k} met town{k} near field{k} at road{k}." for k in range(6_000))
STORY = " ".join(f"Then traveller{k} saw town{k} and rested{k}." for k in range(12))


def test_run_on_awkward_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, STORY), (4, STORY), (5, STORY), (None, STORY), (None, None), (8, "one two"), (9, LONG)]
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, seq string, length string, node string"
    data = [(i, t, None, None, len(t or ""), "own", "own", "own", None) for i, t in rows]
    spark.createDataFrame(data, fields).write.parquet(f"{tmp_path}/documents.parquet")
    placed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in placed} == {5, 9}
    assert sum(r.doc_id == 9 for r in placed) > 10
    fits(placed, 2048)


def test_run_on_an_empty_table(spark, tmp_path):
    nothing(spark, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
