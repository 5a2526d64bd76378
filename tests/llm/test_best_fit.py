import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import PROSE, awkward, nothing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.best_fit import PRODUCTION, Encoder, PackingRules, best_fit, packed_pieces, sequences


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def fits(rows, capacity):
    """Pieces of a sequence lie gapless from 0 within the capacity."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def check(tokenizer, docs, rules):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = packed_pieces(docs, rules).collect()
    want = Counter()
    for i, t in texts:
        ids = ids_of(tokenizer, t)
        first = (len(ids) - 1) % rules.capacity + 1
        bounds = [0, *range(first, len(ids) + 1, rules.capacity)]
        for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[i, n, a, b - a, crc(ids[a:b])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return fits(rows, rules.capacity), rows


def test_awkward_rows(spark, tokenizer):
    check(tokenizer, awkward(spark, clash=("piece", "length", "sequence_id")), PackingRules(capacity=64))
    assert packed_pieces(nothing(spark)).count() == 0


def test_few_sequences_on_the_sample(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    used, rows = check(tokenizer, docs, PRODUCTION)
    assert used == best_fit_decreasing([r.length for r in rows], PRODUCTION.capacity)
    assert used <= -(-sum(r.length for r in rows) // PRODUCTION.capacity) * 1.03 + 1


def test_sequences_hold_the_ids(spark, tokenizer):
    rules = PackingRules(capacity=50)
    docs = spark.createDataFrame([(k, " ".join(PROSE.split()[: k % 40])) for k in range(60)], "doc_id bigint, text string")
    built = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in sequences(docs, rules).collect()}
    texts = {r.doc_id: ids_of(tokenizer, r.text) for r in docs.collect()}
    for r in packed_pieces(docs, rules, with_ids=True).collect():
        assert texts[r.doc_id][r.start : r.start + r.length] == np.frombuffer(r.ids, "<u4").tolist()
    assert Counter(x for s in built.values() for x in s) == Counter(x for s in texts.values() for x in s)


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for size in sorted(sizes, reverse=True):
        fitting = [k for k, g in enumerate(gaps) if g >= size]
        if fitting:
            gaps[min(fitting, key=lambda k: gaps[k])] -= size
        else:
            gaps.append(capacity - size)
    return len(gaps)


def packed_sizes(spark, sizes, rules):
    table = spark.createDataFrame([(k, 0, n) for k, n in enumerate(sizes)], "seq bigint, piece int, length int")
    rows = best_fit(table.repartition(3), rules).collect()
    assert sorted((r.seq, r.length) for r in rows) == sorted(enumerate(sizes))
    return fits(rows, rules.capacity)


def drawn(kind, n, seed):
    """Lengths up to 64: any, few large and many small, many large, one that half of all have, exact pairs."""
    rng = random.Random(seed)
    some = {
        "any": lambda: rng.randint(1, 64),
        "small": lambda: rng.choice([60, 50, *[rng.randint(1, 5)] * 8]),
        "large": lambda: rng.randint(20, 64),
        "hot": lambda: rng.choice([21, rng.randint(1, 64)]),
    }
    if kind == "pairs":
        first = [rng.randint(33, 63) for _ in range(n // 2)]
        return first + [64 - k for k in first]
    return [some[kind]() for _ in range(n)]


@pytest.mark.parametrize("kind", ["any", "small", "large", "hot", "pairs"])
def test_one_range_packs_like_best_fit_decreasing(spark, kind):
    sizes = drawn(kind, 300, 5)
    assert packed_sizes(spark, sizes, PackingRules(capacity=64)) == best_fit_decreasing(sizes, 64)


@pytest.mark.parametrize("kind", ["any", "small", "large", "hot", "pairs"])
def test_many_ranges_pack_nearly_like_best_fit_decreasing(spark, kind):
    sizes = drawn(kind, 600, 6)
    used = packed_sizes(spark, sizes, PackingRules(capacity=64, rows_per_task=40))
    # A range may leave its last sequence partly empty.
    assert used <= best_fit_decreasing(sizes, 64) * 1.03 + 5


def test_pieces_meet_gaps_of_other_ranges(spark):
    """The gaps are all wider than the pieces, so no range holds both kinds; still every gap is filled."""
    sizes = [36] * 200 + [28] * 100 + [25] * 100
    assert packed_sizes(spark, sizes, PackingRules(capacity=64, rows_per_task=30)) == 200


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from("()"), max_size=8), min_size=1, max_size=6))
def test_levels_match_like_brackets(ranges):
    """The level of what ranges leave over finds the partner that one stack over all of them would."""
    stack, want, left = [], set(), []
    for part, marks in enumerate(ranges):
        pieces, gaps = marks.count(")"), marks.count("(")
        left.append((part, pieces, gaps))
        for k in range(pieces):
            if stack:
                want.add((part, k, *stack.pop()))
        stack += [(part, j) for j in range(gaps)]
    balance, levels = 0, defaultdict(list)
    for part, pieces, gaps in left:
        for k in range(pieces):
            levels[balance - k].append((part, -1, k))
        for j in range(gaps):
            levels[balance + j + 1 - pieces].append((part, 1, j))
        balance += gaps - pieces
    got = set()
    for marks in levels.values():
        marks.sort()
        for before, here in zip(marks, marks[1:]):
            if here[1] == -1 and before[1] == 1:
                got.add((here[0], here[2], before[0], before[2]))
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_tokenizers_library(text):
    global _encoder, _library
    if "_encoder" not in globals():
        _encoder = Encoder(PRODUCTION)
        _library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for t in (text, text + "<|endoftext|>", "Über " + text + " naïve’s  \n\n 12345"):
        assert list(_encoder(t)) == _library.encode(t, add_special_tokens=False).ids
