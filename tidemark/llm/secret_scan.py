"""Secret scans: three patterns and sliding-window entropy over candidate strings.

Only DataFrame functions are used and every document is scanned inside its row.  Spans are
code point positions, end exclusive.

* ``assign``, ``access`` and ``hex`` are the base kinds, leftmost and without overlap for
  each kind.
* ``entropy`` looks at candidate strings (maximal runs of key characters).  A window slides
  over the candidate; the count of the character that enters and of the one that leaves is
  updated, and with them the sum of c*log2(c), from which the window's Shannon entropy
  follows.  The threshold depends on the characters in use: random windows of each alphabet
  miss theirs in at most one case of twenty, while paths and identifiers with separators,
  and words of one case, have to reach more than prose does.  Hot windows of a candidate
  make one span.  Candidates of an allowed form, and spans with an allowed part, are
  suppressed; where base spans cover a part of a span, the rest of it is added.  Base spans
  are never suppressed.

The characters of a candidate are split once and each window costs the same, so time grows
with the length of candidates alone.

Edge cases: a null text counts as empty and has no spans; repeated rows get equal spans; an
empty table gives an empty table; input columns named like a result are replaced by it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, text_or_empty, unpacked, with_result

# Patterns and lengths of the base kinds.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
MIN_ASSIGNED = 6
# A run of at least so many characters is the base match that passes the length rule.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

SPAN = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class EntropyRules:
    window: int = 20
    alphabet: str = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/=_-"
    #: Bits a window must reach.  Up to ``both_cases_bits`` the alphabet is one of random
    #: keys without separators, and at most 5 % of its random windows of 20 lie below.
    hex_bits: float = 2.9
    one_case_and_digits_bits: float = 3.53
    both_cases_and_digits_bits: float = 3.77
    both_cases_bits: float = 3.67
    #: Digits and letters with separators (paths, slugs), and anything else.
    mixed_bits: float = 3.9
    letters_bits: float = 4.15
    allowed_patterns: tuple[str, ...] = (
        r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
        r"^[0-9=_+/-]+$",
    )
    #: Sample keys, alphabets and digests of nothing that appear in manuals.
    allowed_parts: tuple[str, ...] = (
        "EXAMPLE", "example", "changeme", "placeholder", "your_", "dummy", "xxxx", "XXXX",
        "abcdefghij", "ABCDEFGHIJ", "0123456789", "d41d8cd98f00b204e9800998ecf8427e",
        "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    )
    #: Allowed parts suppress spans of at most so many characters: longer ones are no samples.
    allowed_length: int = 80

    @property
    def candidate(self) -> str:
        return f"[0-9A-Za-z+/_-]{{{self.window},}}={{0,2}}"


PRODUCTION = EntropyRules()


def _pieces(text: Column, pattern: str, possible: Column) -> tuple[Column, Column]:
    """Texts between the matches of a pattern, and the matches, both in order.

    ``\\G`` ties each attempt to the end of the match before, so a text is read once.
    """
    whole = F.lit(rf"\G([\s\S]*?)({pattern})")
    nothing = F.array().cast("array<string>")
    return (
        F.when(possible, F.regexp_extract_all(text, whole, F.lit(1))).otherwise(nothing),
        F.when(possible, F.regexp_extract_all(text, whole, F.lit(2))).otherwise(nothing),
    )


def _placed(gaps: Column, matches: Column) -> Column:
    """array<struct<start, value>> from gaps and matches."""
    start = F.struct(
        F.lit(0).alias("position"), F.array().cast("array<struct<start:int,value:string>>").alias("found")
    )
    return F.aggregate(
        F.arrays_zip(gaps.alias("gap"), matches.alias("value")),
        start,
        lambda acc, x: F.struct(
            (acc["position"] + F.length(x["gap"]) + F.length(x["value"])).alias("position"),
            F.concat(
                acc["found"],
                F.array(
                    F.struct(
                        (acc["position"] + F.length(x["gap"])).alias("start"), x["value"].alias("value")
                    )
                ),
            ).alias("found"),
        ),
        lambda acc: acc["found"],
    )


def _spans(placed: Column, kind: int) -> Column:
    return F.transform(
        placed,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(kind).alias("kind"),
            (x["start"] + F.length(x["value"])).alias("end"),
        ),
    )


def hot_range(value: Column, bits: Column, rules: EntropyRules) -> Column:
    """struct<first, last>: starts of the first and last window that reach ``bits``; first is
    null without one."""
    w = rules.window
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(w + 2)])
    slots = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(rules.alphabet), c))
    zero = F.struct(
        F.array_repeat(F.lit(0), len(rules.alphabet) + 1).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def step(acc: Column, x: Column) -> Column:
        i, enters, leaves = x["i"], x["enters"], x["leaves"]
        out = F.get(acc["counts"], leaves)
        into = F.get(acc["counts"], enters) - F.when(enters == leaves, 1).otherwise(0)
        total = (
            acc["total"]
            - F.when(leaves > 0, F.get(weight, out) - F.get(weight, out - 1)).otherwise(0.0)
            + F.get(weight, into + 1)
            - F.get(weight, into)
        )
        counts = F.transform(
            acc["counts"],
            lambda c, k: c
            + F.when(k == enters, 1).otherwise(0)
            - F.when((k == leaves) & (leaves > 0), 1).otherwise(0),
        )
        hot = (i >= w - 1) & (F.lit(math.log2(w)) - total / w >= bits)
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            F.when(hot & acc["first"].isNull(), i - (w - 1)).otherwise(acc["first"]).alias("first"),
            F.when(hot, i - (w - 1)).otherwise(acc["last"]).alias("last"),
        )

    left = F.slice(slots, F.lit(1), F.greatest(F.length(value) - w, F.lit(0)))
    pairs = F.zip_with(
        slots,
        F.concat(F.array_repeat(F.lit(0), w), left),
        lambda enters, leaves: F.struct(enters.alias("enters"), leaves.alias("leaves")),
    )
    moves = F.transform(
        F.slice(pairs, F.lit(1), F.length(value)),
        lambda x, i: F.struct(i.alias("i"), x["enters"].alias("enters"), x["leaves"].alias("leaves")),
    )
    return F.aggregate(
        moves, zero, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last"))
    )


def class_bits(value: Column, rules: EntropyRules) -> Column:
    digits, lower, upper = value.rlike("[0-9]"), value.rlike("[a-z]"), value.rlike("[A-Z]")
    plain = value.rlike("^[0-9A-Za-z]+$")
    return (
        F.when(value.rlike("^[0-9a-fA-F]+$"), rules.hex_bits)
        .when(plain & digits & lower & upper, rules.both_cases_and_digits_bits)
        .when(plain & digits, rules.one_case_and_digits_bits)
        .when(plain & lower & upper, rules.both_cases_bits)
        .when(digits & (lower | upper), rules.mixed_bits)
        .otherwise(rules.letters_bits)
    )


def allowed_form(value: Column, rules: EntropyRules) -> Column:
    found = F.lit(False)
    for pattern in rules.allowed_patterns:
        found = found | value.rlike(pattern)
    return found


def has_allowed_part(value: Column, rules: EntropyRules) -> Column:
    found = F.lit(False)
    for part in rules.allowed_parts:
        found = found | value.contains(part)
    return found & (F.length(value) <= rules.allowed_length)


def _uncovered(span: Column, base: Column) -> Column:
    """The parts of a span between base spans, which are sorted by their start."""
    start = F.struct(span["start"].alias("position"), F.array().cast(SPAN).alias("parts"))

    def part(lo: Column, hi: Column) -> Column:
        one = F.array(F.struct(lo.alias("start"), span["kind"].alias("kind"), hi.alias("end")))
        return F.when(lo < hi, one).otherwise(F.array().cast(SPAN))

    touching = F.filter(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    return F.aggregate(
        touching,
        start,
        lambda acc, b: F.struct(
            F.greatest(acc["position"], b["end"]).alias("position"),
            F.concat(acc["parts"], part(acc["position"], b["start"])).alias("parts"),
        ),
        lambda acc: F.concat(acc["parts"], part(acc["position"], span["end"])),
    )


def _with_spans(docs: DataFrame, rules: EntropyRules, text: str) -> DataFrame:
    """row, t, base and spans (both sorted by start, then kind)."""
    df = packed(docs).withColumn("t", text_or_empty(F.col("row").getField(text)))
    t, lowered = F.col("t"), F.lower("t")
    assign_possible = F.lit(False)
    for word in ASSIGN_WORDS:
        assign_possible = assign_possible | lowered.contains(word)
    sources = {
        "assign": (ASSIGN, assign_possible),
        "access": (ACCESS, t.contains("AKIA")),
        "hex": (HEX, t.rlike("[0-9a-f]{24}")),
        "entropy": (rules.candidate, t.rlike(rules.candidate)),
    }
    df = df.withColumns({f"{k}_possible": p for k, (_, p) in sources.items()})
    for kind, (pattern, _) in sources.items():
        gaps, matches = _pieces(t, pattern, F.col(f"{kind}_possible"))
        df = df.withColumns({f"{kind}_gaps": gaps, f"{kind}_matches": matches})
    df = df.withColumns({f"{k}_placed": _placed(F.col(f"{k}_gaps"), F.col(f"{k}_matches")) for k in sources})
    assigned = F.filter(
        "assign_placed",
        lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 1)) >= MIN_ASSIGNED,
    )
    df = df.withColumn(
        "base",
        F.array_sort(
            F.concat(
                _spans(assigned, 0), _spans(F.col("access_placed"), 1), _spans(F.col("hex_placed"), 2)
            )
        ),
    )
    # The class of a candidate is settled first: inside the windows it would be found anew for each.
    classed = F.transform(
        F.filter("entropy_placed", lambda x: ~allowed_form(x["value"], rules)),
        lambda x: F.struct(
            x["start"].alias("start"), x["value"].alias("value"), class_bits(x["value"], rules).alias("bits")
        ),
    )
    candidates = F.transform(
        classed,
        lambda x: F.struct(
            x["start"].alias("start"),
            x["value"].alias("value"),
            hot_range(x["value"], x["bits"], rules).alias("hot"),
        ),
    )
    df = df.withColumn("candidates", candidates)

    def hot_text(x: Column) -> Column:
        first, last = x["hot"]["first"], x["hot"]["last"]
        return F.substring(x["value"], first + 1, last - first + rules.window)

    hot = F.transform(
        F.filter(
            "candidates", lambda x: x["hot"]["first"].isNotNull() & ~has_allowed_part(hot_text(x), rules)
        ),
        lambda x: F.struct(
            (x["start"] + x["hot"]["first"]).alias("start"),
            F.lit(3).alias("kind"),
            (x["start"] + x["hot"]["last"] + rules.window).alias("end"),
        ),
    )
    df = df.withColumn("hot", hot)
    added = F.when(
        F.size("base") > 0, F.flatten(F.transform("hot", lambda x: _uncovered(x, F.col("base"))))
    ).otherwise(F.col("hot"))
    return df.withColumn("added", added).withColumn("spans", F.array_sort(F.concat("base", "added")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def scanned(docs: DataFrame, rules: EntropyRules = PRODUCTION, *, text: str = "text") -> DataFrame:
    """All columns plus base_spans, all_spans (array of start, kind, end), and their listing."""
    df = _with_spans(docs, rules, text)
    return with_result(
        df, base_spans=F.col("base"), all_spans=F.col("spans"), spans=listed(F.col("spans"))
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def redacted(
    docs: DataFrame,
    rules: EntropyRules = PRODUCTION,
    *,
    text: str = "text",
    length: str = "n_chars",
    mark: str = "[SECRET]",
) -> DataFrame:
    """The documents with every span of their text replaced, and the new length if there is a
    column for it; overlapping spans share one mark."""
    df = _with_spans(docs, rules, text)
    start = F.struct(F.lit(0).alias("position"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        fresh = F.concat(
            acc["out"], F.substring(F.col("t"), acc["position"] + 1, x["start"] - acc["position"]), F.lit(mark)
        )
        return F.struct(
            F.greatest(acc["position"], x["end"]).alias("position"),
            F.when(x["start"] >= acc["position"], fresh).otherwise(acc["out"]).alias("out"),
        )

    cleaned = F.aggregate(
        "spans",
        start,
        add,
        lambda acc: F.concat(acc["out"], F.substring(F.col("t"), acc["position"] + 1, F.length("t"))),
    )
    df = df.withColumn("cleaned", F.when(F.size("spans") > 0, cleaned))
    new = {text: F.col("cleaned"), length: F.length("cleaned").cast("long")}
    return unpacked(
        df, **{c: F.coalesce(v, F.col("row").getField(c)) for c, v in new.items() if c in docs.columns}
    )
