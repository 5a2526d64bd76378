"""Periodic stretches of words, found as maximal pairs in the LCP-interval tree of a text.

A *run* is a stretch of words with smallest period q (words q apart are equal) of at least
``min_length`` words and ``min_exponent`` periods that no neighbouring word extends.

* The suffixes of a text, as word numbers, are sorted by prefix doubling; the lengths of the
  common prefixes of neighbours (LCP) give the interval tree, which is walked bottom-up.
* Every interval keeps its positions in lists by the word to the left.  When a child joins its
  interval, positions of different lists make maximal pairs: the common part of length l can be
  extended neither to the left nor to the right.
* A maximal pair at distance p with ``l >= (min_exponent - 1) * p`` and ``l + p >= min_length``
  is a run from its first position on, l + p words long; no extension is needed.  Among pairs of
  one stretch the least distance is the smallest period, the others are its multiples.

Both conditions need l of at least ``min_length * (min_exponent - 1) / min_exponent`` words, so
only intervals that deep are walked, and texts in which no stretch of so many words occurs twice
have no run.  These are told apart in whole Arrow batches, by hashes of word windows: equal windows
have equal hashes, so no run is missed.  Within an interval, positions near each other form one
arithmetic progression; a joining position looks either at its near neighbours or at the class
lists, whichever are fewer, which bounds the work by n * sqrt(n) even for hostile texts.

Everything about a text happens inside its row: no shuffle, nothing depends on other rows.

Edge cases: a null or blank text has no words, no runs and collapses to the empty text; very
long texts are searched whole; repeated rows get equal results; an empty table gives an empty
table.  Input columns named like a result are replaced by it, others are kept.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, text_or_empty, with_result


@dataclass(frozen=True)
class RunRules:
    min_length: int = 24
    min_exponent: int = 3
    #: Words of the texts that one numpy step looks at together; a longer text goes alone.
    words_at_once: int = 300_000

    @property
    def window(self) -> int:
        """The least common part of a pair that can be a run."""
        return -(-self.min_length * (self.min_exponent - 1) // self.min_exponent)


PRODUCTION = RunRules()

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN = "struct<start:bigint,length:bigint,period:bigint>"
RESULT = f"n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed string"


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes that begin there, by prefix doubling."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        places = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(places[1:] != places[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        width *= 2
        if width >= n:
            return order


def common_prefixes(ids: list[int], order: list[int]) -> list[int]:
    """Length of the common prefix of each suffix with its predecessor in the order."""
    n = len(ids)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    lcp, same = [0] * n, 0
    for i in range(n):
        r = rank[i]
        if r == 0:
            same = 0
            continue
        j = order[r - 1]
        end = n - max(i, j)
        while same < end and ids[i + same] == ids[j + same]:
            same += 1
        lcp[r] = same
        if same:
            same -= 1
    return lcp


class _Found:
    """Maximal pairs of one text that satisfy the length constraints."""

    def __init__(self, ids: list[int], rules: RunRules) -> None:
        self.left = [-1, *ids]  # the word to the left of a position; none before the first
        self.rules = rules
        self.period: dict[tuple[int, int], int] = {}

    def leaf(self, position: int) -> tuple[dict[int, list[int]], list[int]]:
        return {self.left[position]: [position]}, [position]

    def pair(self, x: int, y: int, common: int) -> None:
        p = abs(x - y)
        if common + p >= self.rules.min_length:
            stretch = (min(x, y), common + p)
            self.period[stretch] = min(p, self.period.get(stretch, p))

    def joined(self, a: tuple, b: tuple, common: int) -> tuple[dict[int, list[int]], list[int]]:
        """Both position sets as one, after the pairs between them were taken."""
        if len(a[1]) < len(b[1]):
            a, b = b, a
        lists, all_ = a
        reach, left = common // (self.rules.min_exponent - 1), self.left
        for x in b[1]:
            first, last = bisect_left(all_, x - reach), bisect_right(all_, x + reach)
            if last - first <= len(lists):
                for y in all_[first:last]:
                    if left[y] != left[x]:
                        self.pair(x, y, common)
            else:
                for word, members in lists.items():
                    if word != left[x]:
                        for y in members[bisect_left(members, x - reach) : bisect_right(members, x + reach)]:
                            self.pair(x, y, common)
        for word, members in b[0].items():
            mine = lists.setdefault(word, [])
            for x in members:
                insort(mine, x)
        for x in b[1]:
            insort(all_, x)
        return a


def runs_of(ids: np.ndarray, rules: RunRules = PRODUCTION) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text of word numbers, by start, then period."""
    if len(ids) < rules.min_length:
        return []
    order, words = suffix_order(ids).tolist(), ids.tolist()
    lcp = common_prefixes(words, order)
    found, least = _Found(words, rules), rules.window
    open_: list[list] = []  # intervals on the way to the root: common length, positions so far
    child = None
    for r, common in enumerate([*lcp, 0]):
        if common < least:
            while open_:
                depth, node = open_.pop()
                child = found.joined(node, child, depth)
        else:
            if child is None:
                child = found.leaf(order[r - 1])
            while open_ and open_[-1][0] > common:
                depth, node = open_.pop()
                child = found.joined(node, child, depth)
            if open_ and open_[-1][0] == common:
                open_[-1][1] = found.joined(open_[-1][1], child, common)
            else:
                open_.append([common, child])
        child = found.leaf(order[r]) if common >= least else None
    return sorted((start, length, p) for (start, length), p in found.period.items())


def repeats_window(ids: np.ndarray, sizes: np.ndarray, rules: RunRules) -> np.ndarray:
    """Which of the texts (their word numbers one after the other) hold some window twice."""
    w, total = rules.window, len(ids)
    text = np.repeat(np.arange(len(sizes)), sizes)
    if total < w:
        return np.zeros(len(sizes), bool)
    odd = np.uint64(0x9E3779B97F4A7C15)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * odd
    mixed ^= mixed >> np.uint64(29)
    hashed = np.zeros(total - w + 1, np.uint64)
    for k in range(w):
        hashed = hashed * np.uint64(0xD6E8FEB86659FD93) + mixed[k : total - w + 1 + k]
    inside = text[: total - w + 1] == text[w - 1 :]
    text, hashed = text[: total - w + 1][inside], hashed[inside]
    hashed = (hashed ^ (text.astype(np.uint64) + np.uint64(1)) * odd) * odd
    ordered = np.sort(hashed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    out = np.zeros(len(sizes), bool)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, hashed), len(twice) - 1)
        out[text[twice[at] == hashed]] = True
    return out


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run repeats after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [word for word, dropped in zip(words, np.cumsum(gone).tolist(), strict=False) if not dropped]


def _described(words: list[str], ids: np.ndarray, may_repeat: bool, rules: RunRules) -> tuple:
    runs = runs_of(ids, rules) if may_repeat else []
    if not runs:
        return len(words), [], None, " ".join(words)
    strongest = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]))
    return len(words), runs, strongest, " ".join(collapsed(words, runs))


def described(texts: list[str], rules: RunRules = PRODUCTION) -> Iterator[tuple]:
    """n_words, runs, strongest run and collapsed text of each text, a group of texts at a time."""
    for group in _groups(texts, rules.words_at_once):
        number = {w: k for k, w in enumerate(dict.fromkeys(w for words in group for w in words))}
        sizes = np.array([len(words) for words in group])
        ids = np.fromiter((number[w] for words in group for w in words), np.int64, int(sizes.sum()))
        may_repeat = repeats_window(ids, sizes, rules)
        ends = np.cumsum(sizes)
        for words, end, repeats in zip(group, ends.tolist(), may_repeat.tolist(), strict=True):
            yield _described(words, ids[end - len(words) : end], repeats, rules)


def _groups(texts: list[str], most: int) -> Iterator[list[list[str]]]:
    group, held = [], 0
    for text in texts:
        words = WORD.findall(text)
        if group and held + len(words) > most:
            yield group
            group, held = [], 0
        group.append(words)
        held += len(words)
    if group:
        yield group


def with_runs(docs: DataFrame, rules: RunRules = PRODUCTION, *, text: str = "text") -> DataFrame:
    """All columns plus n_words, runs (by start, then period), strongest (the run with the greatest
    length / period; of equal ones the first, then the shorter period) and collapsed."""

    @F.pandas_udf(RESULT)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(described(batch.tolist(), rules))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "strongest", "collapsed"])

    df = packed(docs).select("row", search(text_or_empty(F.col("row").getField(text))).alias("found"))
    return with_result(df, **{c: F.col(f"found.{c}") for c in ("n_words", "runs", "strongest", "collapsed")})
