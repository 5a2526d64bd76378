"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is split into characters; an agenda of adjacent symbol pairs, ordered by the score of
the piece they form and then from left to right, is worked off best first, and each merge
puts the pairs it creates on the agenda.  Symbols that are no pieces fall back to bytes.

No piece reaches across the start of a word, so words are encoded one by one and each
distinct word once per batch.  Short words advance in lock step: in every round each takes the
best entry of its agenda.  Long ones use a heap.

Ids and decoded text are the agenda's own.  Each Arrow batch is checked against the
sentencepiece library, encoding and decoding; ``agrees`` is false where they differ.

Edge cases: a null text counts as empty and gives the begin and end ids only; repeated rows
give equal rows; an empty table gives an empty table; input columns named like a result are
replaced by it.
"""

from __future__ import annotations

import heapq
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import kept_in_worker, packed, text_or_empty, with_result

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NEVER = np.iinfo(np.int32).max
RESULT = "n_tokens bigint, ids binary, decoded string, agrees boolean"


def as_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    packed_ids = array("I", ids)
    if sys.byteorder != "little":
        packed_ids.byteswap()
    return packed_ids.tobytes()


class Vocabulary:
    """Pieces, scores and the merges they allow, read from a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_ids = {}
        self.as_bytes: list[bytes] = []
        pieces: dict[str, int] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.as_bytes.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.as_bytes.append(b"")
            else:
                pieces[piece] = i
                self.as_bytes.append(piece.replace(SPACE, " ").encode())
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece reaches across words; words cannot be encoded one by one")
        self.pieces = pieces
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        #: Characters that only occur inside pieces can take part in merges, too.
        self.symbols = dict(pieces)
        for p in pieces:
            for ch in p:
                self.symbols.setdefault(ch, len(self.symbols) + n)
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in pieces.values()}, reverse=True))}
        self.width = n + len(self.symbols) + 1
        keys, into, rank = [], [], []
        for p, i in pieces.items():
            for k in range(1, len(p)):
                left, right = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if left is not None and right is not None:
                    keys.append(left * self.width + right)
                    into.append(i)
                    rank.append(order[sp.get_score(i)])
        self.into, self.rank = np.array([*into, 0], np.int32), np.array([*rank, NEVER], np.int32)
        self._spread(np.array(keys, np.int64))
        self.merges = dict(zip(keys, zip(rank, into, strict=True), strict=True))
        self.piece_count = n
        self.only_inside = {i: s for s, i in self.symbols.items() if i >= n}
        self.by_point = np.full(0x110000, -1, np.int32)
        for s, i in self.symbols.items():
            if len(s) == 1:
                self.by_point[ord(s)] = i

    def of_points(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; negative where no piece holds the character."""
        symbols = self.by_point[points]
        return np.where(symbols >= 0, symbols, -points - 1)

    def _spread(self, keys: np.ndarray) -> None:
        """A hash table with open addressing over the pairs that merge; the last entry of
        ``rank`` stands for those that do not."""
        self.bits = max(4, len(keys).bit_length() + 3)
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.entry = np.full(1 << self.bits, len(keys), np.int64)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.slots[at[left]] < 0
            _, first = np.unique(at[left], return_index=True)
            placed = np.zeros(len(left), bool)
            placed[first] = True
            placed &= free
            now = left[placed]
            self.slots[at[now]], self.entry[at[now]] = keys[now], now
            left = left[~placed]
            at[left] = (at[left] + 1) & (len(self.slots) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NEVER without a merge) and the piece it forms."""
        key = np.where((left >= 0) & (right >= 0), left * np.int64(self.width) + right, -1)
        at = self._slot(key)
        found = np.full(len(key), len(self.rank) - 1)
        open_ = np.arange(len(key))
        while len(open_):
            here = self.slots[at[open_]]
            hit = here == key[open_]
            found[open_[hit]] = self.entry[at[open_[hit]]]
            open_ = open_[~hit & (here >= 0)]
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
        return self.rank[found], self.into[found]

    def ids(self, symbols: np.ndarray) -> bytes:
        """Ids of merged symbols; what is no piece falls back to bytes."""
        out = []
        for s in symbols.tolist():
            if 0 <= s < self.piece_count:
                out.append(s)
            else:
                out.extend(self.byte_ids[b] for b in (chr(-s - 1) if s < 0 else self.only_inside[s]).encode())
        return as_bytes(out)


def by_heap(vocabulary: Vocabulary, symbols: list[int]) -> list[int]:
    """The agenda of one long word as a heap of (rank, position, left, right)."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int]] = []

    def put(i: int) -> None:
        j = after[i]
        if j < n and symbols[i] >= 0 and symbols[j] >= 0:
            merge = vocabulary.merges.get(symbols[i] * vocabulary.width + symbols[j])
            if merge:
                heapq.heappush(agenda, (merge[0], i, symbols[i], symbols[j]))

    symbols = list(symbols)
    for i in range(n - 1):
        put(i)
    gone = [False] * n
    while agenda:
        _, i, left, right = heapq.heappop(agenda)
        j = after[i]
        if gone[i] or j >= n or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i] = vocabulary.merges[left * vocabulary.width + right][1]
        gone[j] = True
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        put(i)
        if before[i] >= 0:
            put(before[i])
    return [s for s, g in zip(symbols, gone, strict=True) if not g]


def in_lock_step(vocabulary: Vocabulary, symbol: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words at once; each round merges the best pair of every word that has one.

    ``symbol`` holds the symbols of all words, ``sizes`` their numbers.  Returns the same
    for the merged symbols.
    """
    done: list[tuple[np.ndarray, np.ndarray]] = []
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    next_to = np.append(word[:-1] == word[1:], False) if len(word) else np.empty(0, bool)
    rank = np.full(len(word), NEVER, np.int32)
    into = np.zeros(len(word), np.int32)
    fresh = np.flatnonzero(next_to)
    while len(word):
        rank[fresh], into[fresh] = vocabulary.lookup(symbol[fresh], symbol[fresh + 1])
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        counts = np.diff(np.append(starts, len(word)))
        best = np.minimum.reduceat(rank, starts)
        finished = best == NEVER
        if finished.any():
            over = np.repeat(finished, counts)
            done.append((word[over], symbol[over]))
            word, symbol, rank, into = word[~over], symbol[~over], rank[~over], into[~over]
            if not len(word):
                break
            best, counts = best[~finished], counts[~finished]
        at = np.flatnonzero(rank == np.repeat(best, counts))
        at = at[np.append(True, word[at][1:] != word[at][:-1])]
        symbol[at] = into[at]
        stay = np.ones(len(word), bool)
        stay[at + 1] = False
        at = (np.cumsum(stay) - 1)[at]
        word, symbol, rank, into = word[stay], symbol[stay], rank[stay], into[stay]
        last = np.append(word[:-1] != word[1:], True)
        rank[last] = NEVER
        fresh = np.concatenate([at[~last[at]], (at - 1)[(at > 0) & (word[at - 1] == word[at])]])
    if not done:
        return np.empty(0, np.int32), np.zeros(len(sizes), np.int64)
    word, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(word, kind="stable")
    return symbol[order], np.bincount(word, minlength=len(sizes))


class Codec:
    """Encodes texts word by word and decodes ids; keeps the ids of words it has seen."""

    words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    long_word = 64
    most_kept = 600_000

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.known = vocabulary, {"\0": b""}
        self.cuts_lines = vocabulary.by_point[ord("\n")] < 0

    def units(self, text: str) -> list[str]:
        """Keys of the words of a text: without the mark of a leading space, or whole behind
        a NUL.  A character that no piece holds ends a word, too; line feeds are cut there."""
        if not text:
            return []
        plain = "  " not in text and SPACE not in text and "\0" not in text and "\1" not in text
        if plain and text[0] != " " and text[-1] != " " and " \n" not in text and "\n " not in text:
            return (text.replace("\n", " \1 \0") if self.cuts_lines else text).split(" ")
        return ["\0" + u for u in self.words.findall(SPACE + text.replace(" ", SPACE))]

    def learn(self, units: set[str]) -> None:
        new = list(units)
        words = ["\n" if u == "\1" else u[1:] if u[:1] == "\0" else SPACE + u for u in new]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int32)
        symbols = self.vocabulary.of_points(points)
        long = sizes > self.long_word
        in_long = np.repeat(long, sizes)
        merged, counts = in_lock_step(self.vocabulary, symbols[~in_long], sizes[~long])
        ends, known = np.cumsum(counts), self.known
        raw = merged.astype("<u4").tobytes()
        # Words with a symbol that is no piece fall back to bytes, one by one.
        odd = np.flatnonzero((merged < 0) | (merged >= self.vocabulary.piece_count))
        odd = set(np.searchsorted(ends, odd, side="right").tolist())
        places = zip(np.flatnonzero(~long).tolist(), (ends - counts).tolist(), ends.tolist(), strict=True)
        for n, (k, a, b) in enumerate(places):
            known[new[k]] = self.vocabulary.ids(merged[a:b]) if n in odd else raw[4 * a : 4 * b]
        for k in np.flatnonzero(long):
            own = self.vocabulary.of_points(np.array([ord(c) for c in words[k]], np.int64))
            known[new[k]] = self.vocabulary.ids(np.array(by_heap(self.vocabulary, own.tolist()), np.int64))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids with begin and end."""
        if len(self.known) > self.most_kept:
            self.known = {"\0": b""}
        split = [self.units(t) for t in texts]
        look = self.known.get
        found = [list(map(look, units)) for units in split]
        lacking = [k for k, row in enumerate(found) if None in row]
        if lacking:
            self.learn({u for k in lacking for u, ids in zip(split[k], found[k], strict=True) if ids is None})
            for k in lacking:
                found[k] = map(look, split[k])
        begin, end = (as_bytes([i]) for i in (self.vocabulary.begin, self.vocabulary.end))
        return [begin + b"".join(row) + end for row in found]

    def decode(self, ids: bytes) -> str:
        table = self.vocabulary.as_bytes
        raw = b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def _codec_udf(model: str, at_once: int = 512):
    @F.pandas_udf(RESULT)
    def code(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import os

        import public_tokenizers

        path = model if os.path.sep in model else public_tokenizers.path(model)
        codec = kept_in_worker(f"pieces {path}", lambda: Codec(Vocabulary(path)))
        library = codec.vocabulary.library
        for batch in texts:
            # Copies within a batch are coded and checked once.
            place: dict[str, int] = {}
            rows = [place.setdefault(t or "", len(place)) for t in batch]
            out, distinct = [], list(place)
            for k in range(0, len(distinct), at_once):
                part = distinct[k : k + at_once]
                theirs = library.encode(part, add_bos=True, add_eos=True, num_threads=1)
                decoded = library.decode(theirs, num_threads=1)
                for ids, wanted, wanted_text in zip(codec.encode(part), theirs, decoded, strict=True):
                    text = codec.decode(ids)
                    agrees = ids == as_bytes(wanted) and text == wanted_text
                    out.append((len(ids) // 4, ids, text, agrees))
            yield pd.DataFrame([out[r] for r in rows], columns=["n_tokens", "ids", "decoded", "agrees"])

    return code


def coded(docs: DataFrame, model: str = MODEL, *, text: str = "text") -> DataFrame:
    """All columns plus n_tokens, ids (little-endian unsigned 32-bit), decoded and agrees."""
    df = packed(docs).select("row", _codec_udf(model)(text_or_empty(F.col("row").getField(text))).alias("code"))
    return with_result(df, **{c: F.col(f"code.{c}") for c in ("n_tokens", "ids", "decoded", "agrees")})
