import random
from zlib import crc32

import numpy as np
import pytest
from helpers import WORDS, awkward, nothing
from pyspark.sql import functions as F

from tidemark.llm.periodic_runs import PRODUCTION, RunRules, described, runs_of, with_runs
from tidemark.llm.queries import op13_maximal_pair_runs

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words, rules=PRODUCTION):
    """Every stretch of every period, period by period."""
    out = {}
    for q in range(1, len(words) // rules.min_exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(rules.min_length, rules.min_exponent * q):
                out.setdefault((i, length), q)
            i = j
    return sorted((s, n, q) for (s, n), q in out.items())


def plain(text, rules=PRODUCTION):
    words = WORDS.findall(text or "")
    runs = plain_runs(words, rules)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def made(rng):
    """Texts of few words with runs, runs inside runs, and near misses."""
    words = []
    for _ in range(rng.randint(1, 8)):
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 12))]
        words += unit * rng.randint(1, 9) + unit[: rng.randint(0, len(unit))]
        words += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 3))]
    return words


@pytest.mark.parametrize("rules", [PRODUCTION, RunRules(6, 2), RunRules(5, 4), RunRules(3, 3)])
def test_runs_equal_those_of_every_period(rules):
    rng = random.Random(7)
    texts = [made(rng) for _ in range(300)]
    texts += [list("ab" * 400), ["x"] * 300, (["x"] * 20 + ["y"]) * 12, list("abaab") * 40, []]
    texts += [[str(i) for i in range(50)] * 2, sum(([str(i)] + list("abc") * 6 for i in range(60)), [])]
    for words in texts:
        ids = np.unique(words, return_inverse=True)[1] if words else np.array([], np.int64)
        assert runs_of(ids, rules) == plain_runs(words, rules), words
    for got, words in zip(described([" ".join(t) for t in texts], rules), texts, strict=True):
        n, runs, rest = plain(" ".join(words), rules)
        assert (got[0], got[1], got[3]) == (n, runs, rest)


def test_groups_of_texts_do_not_change_the_result():
    rng = random.Random(3)
    texts = [" ".join(made(rng)) for _ in range(60)]
    assert list(described(texts)) == list(described(texts, RunRules(words_at_once=1)))


def test_the_strongest_run_has_the_greatest_exact_exponent():
    # 25 / 8 and 28 / 9 have equal thousandths only when cut; the first is greater.
    first, second = [f"a{i}" for i in range(9)], [f"b{i}" for i in range(8)]
    words = first * 3 + first[:1] + ["-"] + second * 3 + second[:1] + ["+"] + second[:8] * 3 + second[:1]
    (_, runs, strongest, _) = next(described([" ".join(words)]))
    assert runs == [(0, 28, 9), (29, 25, 8), (55, 25, 8)]
    assert strongest == (29, 25, 8)


def test_awkward_rows_and_clashing_columns(spark):
    docs = awkward(spark, clash=("runs", "n_words", "collapsed", "found", "row"))
    rows = with_runs(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, runs, rest = plain(r.text)
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (n, runs, rest)
        assert (r.row, r.found) == ("own row", "own found")
    assert with_runs(nothing(spark)).count() == 0
    assert with_runs(docs).columns.count("runs") == 1


def test_very_long_texts(spark):
    texts = ["x " * 400_000, "a b c d e f g " * 50_000, " ".join(f"w{i % 5_000}" for i in range(200_000)),
             " ".join(f"k{i} " + "a b " * 9 for i in range(10_000))]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in with_runs(docs).select("doc_id", "runs", "n_words").collect()}
    assert [tuple(x) for x in rows[0].runs] == [(0, 400_000, 1)]
    assert [tuple(x) for x in rows[1].runs] == [(0, 350_000, 7)]
    assert [tuple(x) for x in rows[2].runs] == [(0, 200_000, 5_000)]
    assert rows[3].n_words == 190_000 and not rows[3].runs


def test_the_query_has_no_exchange_and_equals_the_plain_search(spark):
    result = op13_maximal_pair_runs(spark, SF_DIR)
    assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: r for r in result.collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(F.length("text") < 6_000).collect()
    assert len(docs) > 100
    import hashlib

    for d in docs:
        words = WORDS.findall(d.text or "")
        h, n = crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        _, runs, rest = plain(" ".join(words))
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        r = got[d.doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(rest.encode()).hexdigest()
        if runs:
            s, k, q = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, k, q, 1000 * k // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
