import random
from collections import Counter
from fractions import Fraction

import pytest
from helpers import WORDS, awkward, nothing

from tidemark.llm.water_filling import MixingRules, mixed, repeated

RULES = MixingRules()


def levels(sizes, rules=RULES):
    """Exact targets, clamping one round after the other."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: rules.weights[k % len(rules.weights)] for k, s in enumerate(order)}
    total, full = Fraction(*rules.share) * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(rules.max_epochs * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > rules.max_epochs * sizes[s]}
        if not over:
            return {s: share.get(s, Fraction(rules.max_epochs * sizes[s])) for s in order}
        full |= over


def table(spark, sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, total in sizes.items():
        while total > 0:
            n = min(total, rng.choice([1, 3, 10, 40, 300]))
            rows.append((len(rows), " ".join(f"w{i}" for i in range(n)), source))
            total -= n
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1000, "b": 1000, "c": 1000},
        {"a": 50, "b": 20_000, "c": 700, "d": 30, "e": 4000, "é": 900, "Z": 600, None: 2500},
        {"only": 500},
        {f"s{k}": 10 + 37 * k * k for k in range(30)},
    ],
)
def test_targets_are_the_water_level_and_are_met_to_the_word(spark, sizes):
    docs = table(spark, sizes)
    want, taken = levels(sizes), Counter()
    for r in mixed(docs).collect():
        assert r.source_size == sizes[r.source] and r.size == len(WORDS.findall(r.text))
        assert r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert 0 <= r.taken <= RULES.max_epochs * r.size and r.taken == r.whole * r.size + r.partial
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= Fraction(1, 2)


def test_shares_above_all_caps_take_every_cap(spark):
    sizes = {"a": 100, "b": 900}
    rows = mixed(table(spark, sizes), MixingRules(share=(5, 1))).collect()
    assert all(r.taken == 2 * r.size and r.target == 2 * r.source_size for r in rows)


def test_reruns_and_partitions_agree_and_another_seed_does_not(spark):
    docs = table(spark, {"a": 9000, "b": 3000, "c": 800, "d": 5000})

    def taken(df, rules=RULES):
        return {r.doc_id: r.taken for r in mixed(df, rules).collect()}

    first = taken(docs)
    assert taken(docs.repartition(7)) == first
    assert taken(docs, MixingRules(seed="other")) != first


def test_rows_of_one_key_share_the_end(spark):
    # All rows of a source have one id: the fractional repetition is spread over them.
    docs = spark.createDataFrame(
        [(None, "a b c d e f g h i j", "x")] * 60 + [(k, "a b", "y") for k in range(2000)],
        "doc_id bigint, text string, source string",
    )
    rows = [r for r in mixed(docs).collect() if r.source == "x"]
    assert {r.taken for r in rows} == {20}
    rows = [r for r in mixed(docs, MixingRules(share=(1, 4))).collect() if r.source == "x"]
    assert len({r.taken for r in rows}) == 1 and 0 <= rows[0].target - sum(r.taken for r in rows) < 61


def test_awkward_rows_and_clashing_columns(spark):
    docs = awkward(spark, clash=("source", "size", "key", "row", "taken", "of", "part"))
    rows = mixed(docs).collect()
    assert len(rows) == docs.count()
    assert {(r.key, r.row, r.of, r.part) for r in rows} == {("own key", "own row", "own of", "own part")}
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * sum(r.size for r in rows), abs=12)
    assert mixed(nothing(spark, "doc_id bigint, text string, source string")).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id bigint, text string, source string")
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixed(blank).collect()] == [(0, 0, 0.0, 0)] * 2


def test_the_mix_holds_the_words_it_takes(spark):
    mix = mixed(table(spark, {"a": 900, "b": 4000, "c": 350, None: 70}))
    words, want = Counter(), Counter()
    for r in repeated(mix).collect():
        words[r.doc_id] += len(WORDS.findall(r.text))
    for r in mix.collect():
        if r.taken:
            want[r.doc_id] = r.taken
    assert words == want
