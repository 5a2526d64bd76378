import random
import re
from collections import Counter
from itertools import combinations

import pytest
from helpers import awkward, nothing

from tidemark.llm.chosen_path import PathRules, _nodes, _unsettled, joined, one_of_each_class
from tidemark.llm.components import connected


def shingles(text, n=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, threshold=0.8):
    """Links of each row and the smallest identifier of its component."""
    sets = [shingles(t) for _, t in rows]
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    members = {}
    for k, (i, _) in enumerate(rows):
        members.setdefault(find(k), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    return [(i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows)]


def check(spark, rows, rules=PathRules()):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.class_id, r.n_links) for r in joined(docs, rules).collect()]
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(got, key=order) == sorted(brute(rows), key=order)


def variants(seed, groups, size, edits, words=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def test_links_and_classes_equal_brute_force(spark):
    check(spark, variants(1, 25, 6, 4))


@pytest.mark.parametrize("bucket", [2, 5])
def test_large_nodes_split_and_near_copies_compare_in_blocks(spark, bucket):
    shared = " ".join(f"common{k}" for k in range(30))
    rows = variants(2, 2, 24, 3) + [
        (1000 + k, shared + " " + " ".join(f"own{k}x{j}" for j in range(35))) for k in range(30)
    ]
    check(spark, rows, PathRules(bucket=bucket))


def test_awkward_rows(spark):
    docs = awkward(spark, clash=("class_id", "stays", "seq", "row"))
    got = joined(docs).collect()
    assert len(got) == docs.count()
    assert all(r.n_links == 0 for r in got if r.doc_id in (1, 2, 3))
    left = one_of_each_class(docs)
    # Three copies, and the same text forty times over, which adds four shingles.
    assert left.columns == docs.columns and left.count() == docs.count() - 3
    assert joined(nothing(spark)).count() == 0


def test_recall_sets_the_number_of_runs():
    rules = PathRules()
    assert (1 - 0.8) ** rules.first_runs <= 1 - rules.recall + 1e-15
    assert (1 - 0.8**4) ** rules.all_runs <= 1 - rules.recall + 1e-15


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(200)] + [(500, 501)], "u bigint, v bigint")
    got = {r.vertex: r.root for r in connected(edges).collect()}
    assert got == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}


def test_records_that_become_alone_below_a_crowded_token_go_on(spark):
    """Alone at depth 2 in all nine runs leaves a chance of 1e-4 to miss a partner, not 5e-7."""
    rules = PathRules(bucket=8)
    crowded = lambda k: [t for run in range(rules.all_runs) for t in (run, 1000 + k, 2, 3)]
    single = lambda k: [9000 + 500 * k + t for t in range(rules.all_runs * rules.depth)]
    rows = [(k, 0, 0, 1, (crowded if k < 20 else single)(k)) for k in range(25)]
    records = spark.createDataFrame(rows, "rec bigint, s0 bigint, s1 bigint, copies bigint, tokens array<int>")
    ends, alone = _nodes(records, 0, rules.first_runs, rules)
    assert ends.count() == 0 and {(r.rec, r.depth) for r in alone.collect()} == {(k, 2) for k in range(20)}
    assert {r.rec for r in _unsettled(ends, alone, rules).collect()} == set(range(20))
