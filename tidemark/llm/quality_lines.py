"""Line-first cleaning: rules per line remove lines, documents that lose too much go.

Only DataFrame functions are used; everything about a document is computed inside its
row, so no rule needs a shuffle and copies or hot sources cost nothing extra.

Words are maximal runs of characters other than blank, tab, line feed, vertical tab, form
feed and carriage return.  Lines are separated by line feeds.

Edge cases: a null text counts as empty and is rejected (fewer than ``min_words`` words);
rows are judged one by one, so repeated rows and null identifiers are kept or rejected
alike; an empty table gives an empty table; input columns named like a result column are
replaced by the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, text_or_empty, unpacked, with_result

# White space between words, symbol characters.
SPACES = "\t\n\x0b\x0c\r"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Parameters of the line and document rules."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: A line of at least this many words must end like a sentence, closing marks aside.
    prose_words: int = 4
    sentence_end: str = ".!?…:;。！？।؟"
    closing: str = "\"'”’»)]*_"
    #: More symbol characters than this share of its words make a line junk.
    max_symbol_percent: int = 30
    #: Navigation: several separators, or a menu entry alone on its line.
    separators: str = "|»›•·→"
    menu_marks: str = " .:>»|-"
    min_separators: int = 3
    menu: tuple[str, ...] = (
        "home", "menu", "login", "log in", "sign in", "sign up", "register", "next", "previous",
        "back", "back to top", "search", "share", "contact", "contact us", "about", "about us",
        "sitemap", "read more", "skip to content",
    )
    boilerplate: tuple[str, ...] = (
        "all rights reserved", "copyright ©", "licensed under the", "terms of use",
        "terms of service", "privacy policy", "cookie policy", "uses cookies",
        "enable javascript", "subscribe to our newsletter", "lorem ipsum",
    )
    #: A document that loses more than this share of its word characters is rejected.
    max_lost_percent: int = 50


PRODUCTION = LineRules()


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def word_chars(text: Column) -> Column:
    """Code points that belong to words."""
    return F.length(F.translate(text, " " + SPACES, "")).cast("long")


def symbol_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def _any(text: Column, parts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | text.contains(part)
    return found


def measured_line(line: Column) -> Column:
    """The line and the line without outer white space."""
    return F.struct(line.alias("line"), F.trim(line, F.lit(" " + SPACES)).alias("trimmed"))


def line_fails(measured: Column, rules: LineRules, rare: bool) -> Column:
    """True for a line with words that breaks a rule; lines without words stay.

    ``rare`` adds the rules that can only fire where the document holds one of their
    characters or phrases (``rare_possible``); elsewhere leaving them out changes nothing.
    """
    trimmed = measured["trimmed"]
    last = F.substring(F.rtrim(trimmed, F.lit(rules.closing)), -1, 1)
    long_line = F.substring_index(trimmed, " ", rules.prose_words - 1) != trimmed
    fails = (~last.isin(*rules.sentence_end) & long_line) | (
        ~long_line & F.lower(F.trim(trimmed, F.lit(rules.menu_marks))).isin(*rules.menu)
    )
    if rare:
        count = F.length(trimmed) - F.length(F.translate(trimmed, " ", "")) + 1
        outside = lambda chars: F.length(trimmed) - F.length(F.translate(trimmed, chars, ""))
        fails = (
            fails
            | (outside(SYMBOLS) * 100 > count * rules.max_symbol_percent)
            | (outside(rules.separators) >= rules.min_separators)
            | _any(F.lower(trimmed), rules.boilerplate)
        )
    return (trimmed != "") & fails


def rare_possible(text: Column, rules: LineRules) -> Column:
    return _any(text, tuple(SYMBOLS + rules.separators)) | _any(F.lower(text), rules.boilerplate)


def _good_lines(rules: LineRules, rare: bool) -> Column:
    kept = F.filter("measured", lambda x: ~line_fails(x, rules, rare))
    return F.transform(kept, lambda x: x["line"])


def _measured(docs: DataFrame, rules: LineRules, text: str) -> DataFrame:
    """row, t, lines and all measures and verdicts."""
    base = packed(docs).withColumn("t", text_or_empty(F.col("row").getField(text)))
    base = base.withColumns({"words": words_of(F.col("t")), "lines": F.split("t", "\n")})
    base = base.withColumns(
        {
            "n": F.size("words"),
            "hashes": F.when(
                F.size("words") >= 3,
                F.transform(
                    F.slice("words", 1, F.size("words") - 2),
                    lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
            "full_lines": F.filter("lines", lambda x: x.rlike(WORD_CHARACTER)),
            "measured": F.transform("lines", measured_line),
            "rare": rare_possible(F.col("t"), rules),
        }
    )
    base = base.withColumn(
        "good_lines", F.when(F.col("rare"), _good_lines(rules, True)).otherwise(_good_lines(rules, False))
    )
    # Equal windows lie side by side once hashes are sorted with their positions.  The
    # positions of repeated ones, in order, each cover the words up to the next, at most 3.
    base = base.withColumn(
        "placed",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    # Two plain arrays, made by transform(): the optimizer moves a field access into the
    # lambdas below, where it would copy the whole array for each element.
    base = base.withColumns(
        {"h": F.transform("placed", lambda x: x["h"]), "at": F.transform("placed", lambda x: x["i"])}
    )
    base = base.withColumn(
        "hits",
        F.sort_array(
            F.array_compact(
                F.transform(
                    "at",
                    lambda i, k: F.when(
                        ((k > 0) & (F.get("h", k - 1) == F.get("h", k)))
                        | (F.get("h", k + 1) == F.get("h", k)),
                        i,
                    ),
                )
            )
        ),
    )
    covered = F.coalesce(
        F.aggregate(
            F.zip_with(
                "hits",
                F.slice("hits", 2, F.greatest(F.size("hits") - 1, F.lit(0))),
                lambda here, following: F.least(F.lit(3), F.coalesce(following - here, F.lit(3))),
            ),
            F.lit(0),
            lambda total, x: total + x,
        ),
        F.lit(0),
    )
    base = base.withColumns({"repeat": covered, "clean": F.array_join("good_lines", "\n")})
    base = base.withColumns({"chars": word_chars(F.col("t")), "left": word_chars(F.col("clean"))})
    failed = (F.col("n") < rules.min_words) | (
        F.col("repeat") * 100 > F.col("n") * rules.max_repeat_percent
    )
    loses = (F.col("chars") - F.col("left")) * 100 > F.col("chars") * rules.max_lost_percent
    return base.withColumns({"failed": failed, "kept": ~failed & ~loses})


def judged(docs: DataFrame, rules: LineRules = PRODUCTION, *, text: str = "text") -> DataFrame:
    """All columns of the documents plus the measures, the cleaned text and the verdict:
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_removed_lines, kept_chars and cleaned."""
    return with_result(
        _measured(docs, rules, text),
        n_words=F.col("n").cast("long"),
        word_chars=F.col("chars"),
        n_symbols=symbol_count(F.col("t")),
        n_dup_lines=(F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long"),
        n_repeat_words=F.col("repeat").cast("long"),
        base_failed=F.col("failed"),
        kept=F.col("kept"),
        n_removed_lines=(F.size("lines") - F.size("good_lines")).cast("long"),
        kept_chars=F.col("left"),
        cleaned=F.col("clean"),
    )


def cleaned_documents(
    docs: DataFrame, rules: LineRules = PRODUCTION, *, text: str = "text", length: str = "n_chars"
) -> DataFrame:
    """The documents that stay, with their cleaned text, and its length if there is a column
    for it."""
    # The row number keeps the optimizer from moving the filter below the measures, where it
    # would work them out a second time.
    df = _measured(docs, rules, text).withColumn("number", F.monotonically_increasing_id())
    df = df.where(F.col("kept") & (F.col("number") >= 0))
    new = {text: F.col("clean"), length: F.length("clean").cast("long")}
    return unpacked(df, **{c: v for c, v in new.items() if c in docs.columns})
