"""Collocations per language, counted in the dictionary of a prefix-free parse.

* **Parse.** Texts are lower-cased and split into pieces and words.  A window of ``max_words - 1``
  words whose hash is divisible by ``trigger`` ends a chunk and begins the next one, so chunks
  overlap by one window, no chunk goes on behind another one's end, and equal passages are cut
  alike wherever they stand.  Distinct chunks and how often each occurs are the dictionary; copies
  are counted before the shuffle and after it stand there once.
* **Count.** Phrases are counted inside distinct chunks, weighted by the chunk's frequency.  A
  phrase belongs to the chunk in which it begins before the overlap, so it is counted once.
* **Levels.** A phrase is as frequent as its parts at most.  Words are counted by the parse itself.
  Pairs are looked at where both words have the least count, first by their 64-bit hashes alone;
  phrases are spelled out and counted where all their pairs have it.  A bit filter of fixed size
  (``filter_bits``) tells.  Equal hashes and the filter's false positives only cost work: counts are
  exact, and what lies below the least count is dropped by its count alone.  The filter's bits, never
  phrases, pass the driver: ``filter_bits / 8`` bytes at most, whatever the size of the corpus.
* **Score.** Every cut of a phrase meets the counts of its two sides by equi-joins on the phrase;
  the lowest score counts.  Phrases that a longer one contains and nearly always accompanies go.

No step groups by language alone but the last one, which ranks at most ``salts * top`` phrases of
a language.

Edge cases: a null text has no words; a null language is ``und``, together with rows that say so.
Copies and repeated rows all count.  A text of any length and a piece without a trigger are taken
whole.  An empty table gives an empty table.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.llm.shared import packed, stored, text_or_empty


@dataclass(frozen=True)
class PhraseRules:
    max_words: int = 4
    min_count: int = 30
    #: A phrase goes if a longer candidate with this share (percent) of its count contains it.
    contained_percent: int = 80
    scale: int = 2_000_000
    top: int = 2_000
    #: One window in so many is expected to end a chunk.
    trigger: int = 16
    filter_bits: int = 1 << 26
    #: Characters that one numpy step looks at together; a longer text goes alone.
    chars_at_once: int = 8_000_000
    salts: int = 64


PRODUCTION = PhraseRules()

#: Arrow schemas of what the workers return.
DICTIONARY = pa.schema(
    [("lang", pa.string()), ("overlaps", pa.bool_()), ("chunk", pa.string()), ("n", pa.int64())]
)
COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])
PLACES = pa.schema([("place", pa.int64())])
HASH_COUNTS = pa.schema([("hash", pa.int64()), ("f", pa.int64())])

_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on, as far as they reach."""
    total = max(len(hashes) - size + 1, 0)
    out = np.zeros(total, np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(31))) * _FACTOR + hashes[k : total + k]
    return (out ^ (out >> np.uint64(29))) * _SPREAD


#: Ends a piece among the words; no byte of UTF-8.
_BREAK = b"\xff"
_UPPER, _ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(_UPPER + _ENDS, _UPPER.lower() + _BREAK * len(_ENDS))


def _batch(*columns, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class _Words:
    """Numbers and hashes of words."""

    def __init__(self, words: pa.Array) -> None:
        coded = words.dictionary_encode()
        self.names = coded.dictionary
        self.ids = coded.indices.to_numpy()
        self.hashes = _word_hashes(self.names.to_pylist())[self.ids]


def _tokens(texts: list[str]) -> pa.Array:
    """Words of lower-cased texts, a break after every piece."""
    blob = _BREAK.join([t.encode() for t in texts]).translate(_PLAIN)
    blob = (blob.replace(_BREAK, b" " + _BREAK + b" ") + b" " + _BREAK).lstrip()
    # Arrow only splits strings; a break is none, but this step looks at bytes alone.
    whole = pa.Array.from_buffers(pa.string(), 1, [None, pa.array([0, len(blob)], pa.int32()).buffers()[1], pa.py_buffer(blob)])
    return pc.ascii_split_whitespace(whole).flatten().view(pa.binary())


def chunks_of(texts: list[str], rules: PhraseRules = PRODUCTION) -> tuple[list[bytes], list[bytes]]:
    """Chunks that end with a window of the next one, and chunks that end with their piece.

    Only A-Z are lower-cased, and words are separated by blanks and tabs.
    """
    return _parsed(texts, rules)[:2]


def _parsed(texts: list[str], rules: PhraseRules) -> tuple[list[bytes], list[bytes], pa.Array, np.ndarray]:
    """The chunks of ``chunks_of``, the distinct words and how often each occurs."""
    overlap = rules.max_words - 1
    tokens = _tokens(texts)
    words = _Words(tokens)
    times = np.bincount(words.ids, minlength=len(words.names))
    end = pc.index(words.names, pa.scalar(_BREAK, pa.binary())).as_py()
    breaks = np.flatnonzero(words.ids == end)
    starts = np.concatenate(([0], breaks[:-1] + 1))
    starts, ends = starts[starts < breaks], breaks[starts < breaks]
    windows = _window_hashes(words.hashes, overlap)
    at = np.flatnonzero(windows % np.uint64(rules.trigger) == 0)
    piece = np.searchsorted(starts, at, "right") - 1
    inside = piece >= 0
    at, piece = at[inside], piece[inside]
    at = at[(at > starts[piece]) & (at + overlap <= ends[piece])]
    begins = np.sort(np.concatenate((starts, at)))
    piece = np.searchsorted(starts, begins, "right") - 1
    goes_on = np.append(piece[1:] == piece[:-1], False)[: len(begins)]
    stops = np.where(goes_on, np.append(begins[1:], 0)[: len(begins)] + overlap, ends[piece])

    blob = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), tokens), b" ")[0].as_py()
    lengths = pc.binary_length(tokens).to_numpy().astype(np.int64)
    after = np.cumsum(lengths + 1)  # where the next word begins

    def joined(which: np.ndarray) -> list[bytes]:
        first, last = begins[which], stops[which] - 1
        return [blob[a:b] for a, b in zip((after[first] - lengths[first] - 1).tolist(), (after[last] - 1).tolist(), strict=True)]

    is_word = np.arange(len(times)) != end
    return joined(goes_on), joined(~goes_on), words.names.filter(pa.array(is_word)), times[is_word]


def dictionary(docs: DataFrame, rules: PhraseRules = PRODUCTION, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, overlaps (whether the chunk ends with a window of the next one), chunk, n."""
    return parsed(docs, rules, text=text, lang=lang)[0]


def parsed(
    docs: DataFrame, rules: PhraseRules = PRODUCTION, *, text: str = "text", lang: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """The dictionary, and the words of every language: lang, phrase, words, f.

    The parse sees every word, so words are counted on the way; among the chunks their rows
    are those that neither overlap nor do not.
    """

    def rows(language: str, overlaps: bool | None, names: pa.Array, times: Sequence[int]) -> pa.RecordBatch:
        k = len(names)
        languages = pa.DictionaryArray.from_arrays(pa.array(np.zeros(k, np.int32)), pa.array([language])).cast(pa.string())
        flags = pa.array(np.full(k, overlaps)) if overlaps is not None else pa.nulls(k, pa.bool_())
        return _batch(languages, flags, names.cast(pa.string()), times, schema=DICTIONARY)

    def counted(held: dict[str, list[str]]) -> Iterator[pa.RecordBatch]:
        for language, texts in held.items():
            *both, words, each = _parsed(texts, rules)
            yield rows(language, None, words, each)
            for overlaps, chunks in zip((True, False), both, strict=True):
                times = Counter(chunks)
                yield rows(language, overlaps, pa.array(list(times), pa.binary()), list(times.values()))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        size = 0
        for batch in batches:
            for language, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(language, []).append(own)
                size += len(own)
                if size >= rules.chars_at_once:
                    yield from counted(held)
                    held, size = {}, 0
        yield from counted(held)

    row = F.col("row")
    texts = packed(docs).select(
        F.coalesce(row.getField(lang), F.lit("und")).alias("lang"), text_or_empty(row.getField(text)).alias("text")
    )
    chunks = texts.where(F.length("text") > 0).mapInArrow(parse, from_arrow_schema(DICTIONARY))
    found = stored(chunks.groupBy("lang", "overlaps", "chunk").agg(F.sum("n").alias("n")), "chunk-dictionary")
    words = found.where(F.col("overlaps").isNull())
    return found.where(F.col("overlaps").isNotNull()), words.select(
        "lang", F.col("chunk").alias("phrase"), F.lit(1).alias("words"), F.col("n").alias("f")
    )


def _language_hashes(languages: list[str]) -> np.ndarray:
    return np.array([crc32(x.encode()) for x in languages], np.uint64) * _SPREAD


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each phrase hash."""
    most = np.uint64(bits - 1)
    return (hashes >> np.uint64(5)) & most, ((hashes * _FACTOR) >> np.uint64(23)) & most


def _words_in(strings: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of strings with single blanks, one string after the other, and how many each has."""
    lists = pc.split_pattern(strings, " ")
    return lists.flatten(), lists.value_lengths().to_numpy().astype(np.int64)


def bit_filter(frequent: DataFrame, n: int, rules: PhraseRules) -> np.ndarray:
    """Bits of the frequent phrases of n words, as unsigned 64-bit words."""

    def hashed(batch: pa.RecordBatch) -> np.ndarray:
        language = batch.column(0).dictionary_encode()
        hashes = _window_hashes(_Words(_words_in(batch.column(1))[0]).hashes, n)[::n]
        return hashes ^ _language_hashes(language.dictionary.to_pylist())[language.indices.to_numpy()]

    return _bits_at(frequent.select("lang", "phrase"), hashed, rules)


def filter_of(hashes: DataFrame, rules: PhraseRules) -> np.ndarray:
    """Bits of phrase hashes (column ``hash``), as unsigned 64-bit words."""
    return _bits_at(hashes.select("hash"), lambda batch: batch.column(0).to_numpy().view(np.uint64), rules)


def _bits_at(rows: DataFrame, hashed: Callable[[pa.RecordBatch], np.ndarray], rules: PhraseRules) -> np.ndarray:
    # One step in Python alone: every further one would be another worker for each task.
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch(np.concatenate(_places(hashed(batch), rules.filter_bits)).astype(np.int64), schema=PLACES)

    places = rows.mapInArrow(marked, from_arrow_schema(PLACES))
    # One row for each 64 bits: at most filter_bits / 64 rows reach the driver.
    found = (
        places.groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(rules.filter_bits // 64, np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint64)
    return out


def _holds(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1


class _Begins:
    """Words of some chunks, and where phrases whose parts may all be frequent begin."""

    def __init__(self, batches: list[pa.RecordBatch], part: int, bits: np.ndarray, rules: PhraseRules) -> None:
        languages, overlaps, strings, times = pa.Table.from_batches(batches).combine_chunks().columns
        language = languages.combine_chunks().dictionary_encode()
        self.known, code = language.dictionary, language.indices.to_numpy()
        words, lengths = _words_in(strings.combine_chunks())
        self.words = _Words(words)
        self.owner = owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.left = (np.cumsum(lengths)[owner] - np.arange(len(owner))).astype(np.int32)
        self.code, self._times = code[owner], times.to_numpy()
        # A phrase begins before the overlap and ends inside the chunk.
        self.before = self.left > np.where(overlaps.to_numpy(), rules.max_words - 1, 0)[owner]
        self._spread = _language_hashes(self.known.to_pylist())
        self.part = part
        hashes = self.hashes(part)
        first, second = _places(hashes, rules.filter_bits)
        self.frequent = np.zeros(len(owner), bool)
        self.frequent[: len(hashes)] = _holds(bits, first)
        self.frequent[self.frequent] = _holds(bits, second[self.frequent[: len(hashes)]])

    def hashes(self, n: int) -> np.ndarray:
        """Hash of the language and the n words from each position on, as far as they reach."""
        hashes = _window_hashes(self.words.hashes, n)
        return hashes ^ self._spread[self.code[: len(hashes)]]

    def times(self, at: np.ndarray) -> np.ndarray:
        return self._times[self.owner[at]]

    def of(self, n: int) -> np.ndarray:
        """Positions where phrases of n words begin."""
        ok = self.before & (self.left >= n)
        for k in range(n - self.part + 1):
            ok[: len(ok) - k] &= self.frequent[k:]
        return np.flatnonzero(ok)


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position of every distinct key, and the sum of its times."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return order[first], np.add.reduceat(times[order], first)


def _counted(chunks: DataFrame, found: Callable[[_Begins], Iterator[pa.RecordBatch]], schema: pa.Schema,
             part: int, bits: np.ndarray, rules: PhraseRules) -> DataFrame:
    """What ``found`` says of the chunks, many at a time."""
    shared = chunks.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(2).nbytes
            if size >= rules.chars_at_once:
                yield from found(_Begins(held, part, shared.value, rules))
                held, size = [], 0
        if held:
            yield from found(_Begins(held, part, shared.value, rules))

    return chunks.select("lang", "overlaps", "chunk", "n").mapInArrow(count, from_arrow_schema(schema))


def frequent_hashes(chunks: DataFrame, n: int, part: int, bits: np.ndarray, rules: PhraseRules) -> DataFrame:
    """hash of phrases of n words: every one with the least count is among them.

    Phrases of one hash are counted together, so some that are rarer get through.
    """

    def found(begins: _Begins) -> Iterator[pa.RecordBatch]:
        at = begins.of(n)
        if len(at):
            hashes = begins.hashes(n)[at]
            one, sums = _summed(hashes, begins.times(at))
            yield _batch(hashes[one].view(np.int64), sums, schema=HASH_COUNTS)

    counts = _counted(chunks, found, HASH_COUNTS, part, bits, rules)
    return counts.groupBy("hash").agg(F.sum("f").alias("f")).where(F.col("f") >= rules.min_count).select("hash")


def phrase_counts(chunks: DataFrame, sizes: Sequence[int], part: int, bits: np.ndarray, rules: PhraseRules) -> DataFrame:
    """lang, phrase, words, f of the phrases of these sizes whose parts of ``part`` words may all be
    in the filter."""

    def found(begins: _Begins) -> Iterator[pa.RecordBatch]:
        ids, spelled, known = begins.words.ids, begins.words.names, begins.known
        for n in sizes:
            at = begins.of(n)
            if not len(at):
                continue
            key, top, names = begins.code[at].astype(np.int64), len(known), len(spelled)
            for k in range(n):
                if top * names >= 1 << 62:
                    key = np.unique(key, return_inverse=True)[1]
                    top = int(key.max()) + 1
                key = key * names + ids[at + k]
                top *= names
            one, sums = _summed(key, begins.times(at))
            at = at[one]
            phrases = pc.binary_join_element_wise(*[spelled.take(pa.array(ids[at + k])) for k in range(n)], " ")
            languages = known.take(pa.array(begins.code[at]))
            yield _batch(languages, phrases, np.full(len(at), n, np.int32), sums, schema=COUNTS)

    counts = _counted(chunks, found, COUNTS, part, bits, rules)
    return counts.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def frequent_phrases(chunks: DataFrame, words: DataFrame, rules: PhraseRules = PRODUCTION) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``max_words`` words with the least count: lang, phrase, words, f; and the
    words of every language: lang, n."""
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    enough = F.col("f") >= rules.min_count
    frequent = words.where(enough)
    pairs = frequent_hashes(chunks, 2, 1, bit_filter(frequent, 1, rules), rules)
    sizes = list(range(2, rules.max_words + 1))
    longer = phrase_counts(chunks, sizes, 2, filter_of(pairs, rules), rules).where(enough)
    return frequent.unionByName(stored(longer, "phrases")), totals


def scored(frequent: DataFrame, rules: PhraseRules = PRODUCTION) -> DataFrame:
    """lang, phrase, words, a, l, r, score of every candidate; the lowest-scoring cut counts."""
    side = frequent.select("lang", "phrase", "f")
    cuts = frequent.where("words >= 2").select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k")
    )
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "rest", F.expr("substring_index(phrase, ' ', k - words)")
    )
    cuts = cuts.join(side.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(side.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"(cast(a as decimal(19,0)) * {rules.scale}) div (cast(l as decimal(19,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return (
        cuts.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    )


def contained(frequent: DataFrame, rules: PhraseRules = PRODUCTION) -> DataFrame:
    """lang, phrase, longest_f: the greatest count of a longer candidate around a phrase."""
    words = F.split("phrase", " ")
    parts = [
        F.when(
            (F.col("words") > size) & (F.col("words") >= begin + size),
            F.array_join(F.slice(words, begin + 1, size), " "),
        )
        for size in range(2, rules.max_words)
        for begin in range(rules.max_words - size + 1)
    ]
    if not parts:
        return frequent.select("lang", "phrase", F.col("f").alias("longest_f")).limit(0)
    inner = frequent.where("words >= 3").select("lang", F.explode(F.array(*parts)).alias("phrase"), "f")
    return inner.where("phrase IS NOT NULL").groupBy("lang", "phrase").agg(F.max("f").alias("longest_f"))


def collocations(
    docs: DataFrame, rules: PhraseRules = PRODUCTION, *, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of every language."""
    frequent, totals = frequent_phrases(*parsed(docs, rules, text=text, lang=lang), rules)
    share = F.col("longest_f").cast("decimal(19,0)") * 100
    left = scored(frequent, rules).join(contained(frequent, rules), ["lang", "phrase"], "left")
    left = left.where(F.col("longest_f").isNull() | (share < F.col("a").cast("decimal(19,0)") * rules.contained_percent))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First among phrases of one salt, then among the winners: no task ranks a whole language.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(rules.salts))
    winners = left.withColumn("salt", salt).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    )
    ranked = winners.where(F.col("place") <= rules.top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    )
    return (
        ranked.where(F.col("rank") <= rules.top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
