import random
import re
from collections import Counter, defaultdict
from itertools import pairwise

import pytest
from helpers import awkward, nothing

from tidemark.llm import parsed_phrases
from tidemark.llm.parsed_phrases import (
    PRODUCTION,
    PhraseRules,
    bit_filter,
    chunks_of,
    collocations,
    dictionary,
    filter_of,
    frequent_hashes,
    parsed,
    phrase_counts,
)
from tidemark.llm.queries import op11_parsed_phrases

SF_DIR = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, rules=PRODUCTION):
    """Every phrase of every text counted at its place, no parse."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, rules.max_words + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= rules.min_count}
        around = defaultdict(list)
        for longer, b in frequent.items():
            for size in range(2, len(longer)):
                for i in range(len(longer) - size + 1):
                    around[longer[i : i + size]].append(b)
        found = []
        for p, a in frequent.items():
            if any(100 * b >= rules.contained_percent * a for b in around[p]):
                continue
            score, _, left, right = min(
                (rules.scale * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[: rules.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(docs, rules=PRODUCTION):
    return sorted(tuple(r) for r in collocations(docs, rules).collect())


def made(rng, count):
    words = ["a", "b", "c", "É", "New", "york", "the", "日本", "x-1", "d'or"]
    rows = []
    for _ in range(count):
        text = ""
        for _ in range(rng.randint(0, 30)):
            text += rng.choice(["new York city hall", "The a", "of the year", *words]) + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "\r"])
        rows.append((rng.choice(["en", "de", "en", "und", None]), text))
    return rows + rows[: count // 3]


@pytest.mark.parametrize("rules", [PhraseRules(min_count=3, trigger=3), PhraseRules(min_count=2, top=7, filter_bits=64),
                                   PhraseRules(min_count=4, max_words=2, trigger=1), PhraseRules(min_count=3, max_words=5, chars_at_once=300, salts=2)])
def test_equals_counting_every_phrase(spark, rules):
    rows = made(random.Random(5), 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    want = plain(rows, rules)
    assert len(want) > 5
    assert got(docs, rules) == want


def test_chunks_overlap_by_one_window_and_none_goes_on_behind_another():
    rng = random.Random(1)
    rules, overlap = PhraseRules(trigger=4), 3
    pieces = [[rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(1, 60))] for _ in range(200)]
    texts = [b" ".join(p).decode() for p in pieces]
    for piece, text in zip(pieces, texts, strict=True):
        going_on, last = chunks_of([text], rules)
        parts = [c.split(b" ") for c in (*going_on, *last)]
        for a, b in pairwise(parts):
            assert a[-overlap:] == b[:overlap]
        assert sum((p[:-overlap] for p in parts[:-1]), []) + parts[-1] == piece
    going_on, last = chunks_of(texts, rules)
    assert len(last) == len(pieces)
    # A window that ended one chunk stands nowhere inside another one.
    ends = {tuple(c.split(b" ")[-overlap:]) for c in going_on}
    for c in (*going_on, *last):
        words = c.split(b" ")
        inner = range(1, len(words) - overlap + (c not in set(going_on)))
        assert not any(tuple(words[i : i + overlap]) in ends for i in inner)


def test_copies_stand_in_the_dictionary_once(spark):
    text = "One two three four five six seven. Eight nine ten eleven\ntwelve"
    docs = spark.createDataFrame([("en", text)] * 500, "lang string, text string").repartition(6)
    rows = dictionary(docs).collect()
    assert {r.n for r in rows} == {500}
    assert sum(len(r.chunk.split(" ")) - (3 if r.overlaps else 0) for r in rows) == len(re.findall(r"\w+", text))


def test_a_full_filter_only_costs_work(spark):
    rows = made(random.Random(8), 60)
    docs = spark.createDataFrame(rows, "lang string, text string")
    small = PhraseRules(min_count=2, filter_bits=64)
    level = spark.createDataFrame([("en", f"w{i}") for i in range(500)], "lang string, phrase string")
    assert bit_filter(level, 1, small).tolist() == [0xFFFFFFFFFFFFFFFF]
    assert got(docs, small) == got(docs, PhraseRules(min_count=2)) == plain(rows, small)


def test_awkward_rows_and_tables(spark):
    docs = awkward(spark, clash=("lang", "n", "f", "chunk", "phrase"))
    rules = PhraseRules(min_count=2)
    assert got(docs, rules) == plain([(r.lang, r.text) for r in docs.collect()], rules)
    assert got(nothing(spark, "text string, lang string")) == []
    long = [(None, "a b " * 200_000), ("x", " ".join(f"w{i}" for i in range(300_000)) + ". " + "z " * 100)]
    assert got(spark.createDataFrame(long, "lang string, text string")) == plain(long)


def test_pieces_are_split_and_lowered_as_defined():
    whole = PhraseRules(trigger=1 << 40)
    texts = ["A\tÉ b.c:D\x0be\x0cf  g\r\n!?", "", "x\x1cy\xa0z\x85w"]
    assert chunks_of(texts, whole) == ([], ["a É b".encode(), b"c", b"d", b"e", b"f g", "x\x1cy\xa0z\x85w".encode()])
    assert chunks_of([""], whole) == chunks_of([], whole) == ([], [])


def test_counts_beyond_64_bits_are_exact(spark):
    from tidemark.llm.parsed_phrases import scored

    a = 8_000_000_000_000_000_000
    rows = [("en", "a b", 2, a), ("en", "a", 1, a + 1), ("en", "b", 1, a + 2)]
    (r,) = scored(spark.createDataFrame(rows, "lang string, phrase string, words int, f bigint")).collect()
    assert r.score == 2_000_000 * a // (2 * a + 3)


def test_query_equals_counting_every_phrase(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = plain([(r.lang, r.text) for r in docs.collect()])
    assert len(want) >= 50
    assert sorted(tuple(r) for r in op11_parsed_phrases(spark, SF_DIR).collect()) == want


def test_words_are_counted_by_the_parse(spark):
    rows = made(random.Random(3), 80)
    chunks, words = parsed(spark.createDataFrame(rows, "lang string, text string").repartition(4), PhraseRules(trigger=3))
    want = Counter()
    for lang, text in rows:
        want.update((lang or "und", w) for w in re.findall(r"[^\x20\x09]+", re.sub(r"[.,;:!?\x0A-\x0D]", " ", lowered(text))))
    assert {(r.lang, r.phrase): r.f for r in words.collect()} == want
    assert chunks.where("overlaps IS NULL").count() == 0


def test_the_dictionary_is_read_twice(spark, monkeypatch):
    purposes = []
    monkeypatch.setattr(parsed_phrases, "stored", lambda df, purpose: purposes.append(purpose) or df)
    docs = spark.createDataFrame(made(random.Random(4), 40), "lang string, text string")
    collocations(docs, PhraseRules(min_count=2))
    assert purposes == ["chunk-dictionary", "phrases"]


def test_hashes_of_all_frequent_pairs_get_through(spark):
    rules = PhraseRules(min_count=3, trigger=4)
    rows = [("en", text) for _, text in made(random.Random(6), 120)]
    chunks, words = parsed(spark.createDataFrame(rows, "lang string, text string").repartition(4), rules)
    hashes = frequent_hashes(chunks, 2, 1, bit_filter(words.where("f >= 3"), 1, rules), rules)
    counts = phrase_counts(chunks, [2], 2, filter_of(hashes, rules), rules)
    pairs = Counter()
    for _, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            pairs.update(map(" ".join, pairwise(re.findall(r"[^\x20\x09]+", piece))))
    assert {r.phrase: r.f for r in counts.where("f >= 3").collect()} == {p: f for p, f in pairs.items() if f >= 3}
