"""Mixing sources to target weights by capped water-filling.

* Weights are dealt to the sources in their order and share out ``share`` of all sizes.
* Sources whose share exceeds ``max_epochs`` times their size are clamped there; what they
  leave is shared out again by the weights of the others, until no share is above its cap.
  Every round is one aggregate over the source table and gives the driver three numbers.
* A source's target is met by whole repetitions of all its documents and a fractional one:
  documents come in the order of a seeded key, and the fractional repetition ends where the
  remaining words are used up.  That place is found from exact sums below key prefixes, one
  prefix after the other, so no source is ever sorted or held by one task.  Rows that share the
  key at the end (normally one) all take the same fraction of their words.

So a source takes its target to the word, but for fractions of words lost by rows that share
the last key.  Documents then only need a comparison with the numbers of their source.

Edge cases: a null text has no words, and null is a source of its own, after all others.
Rows with equal or null ids share a key and are taken alike.  Sources without words get the
target 0.  An empty table gives an empty table.  Input columns named like a result are
replaced by it, others are kept.  Where the caps of all sources together are below the share,
every source takes its cap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, stored, text_or_empty, with_result


@dataclass(frozen=True)
class MixingRules:
    weights: tuple[int, ...] = (5, 2, 1)
    #: Words of the mix as a ratio of all words.
    share: tuple[int, int] = (3, 2)
    max_epochs: int = 2
    seed: str = "mix-1"
    #: Hexadecimal digits of the key that one search step looks at.
    step: int = 3


PRODUCTION = MixingRules()

_WIDE, _NARROW = "decimal(19,0)", "decimal(18,0)"


def word_count(text: Column) -> Column:
    """Maximal runs of characters other than blank, tab, line feeds, form feed and return."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def seeded_key(record: Column, rules: MixingRules = PRODUCTION) -> Column:
    """32 hexadecimal digits in an order that only seed and id decide."""
    return F.md5(F.concat(F.lit(rules.seed + "|"), F.coalesce(record.cast("string"), F.lit("null"))).cast("binary"))


def weighed(sizes: DataFrame, rules: MixingRules = PRODUCTION) -> DataFrame:
    """The source table with its weights, dealt in code point order, null last.

    Places come from a range sort and the row counts of its partitions.
    """
    sizes = stored(
        sizes.sort(F.col("source").asc_nulls_last()).select("*", F.monotonically_increasing_id().alias("at")),
        "sorted-sources",
    )
    part = F.shiftright("at", 33)
    ahead = sizes.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead")
    )
    place = F.col("ahead") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    dealt = F.element_at(
        F.array(*[F.lit(w).cast("long") for w in rules.weights]),
        (place % len(rules.weights) + 1).cast("int"),
    )
    return sizes.withColumn("part", part).join(ahead, "part").select("source", "source_size", dealt.alias("weight"))


def targets(sources: DataFrame, rules: MixingRules = PRODUCTION) -> DataFrame:
    """source, source_size, weight -> also target (double) and goal, the target in whole words."""
    up, down = rules.share
    cap = F.col("source_size") * rules.max_epochs
    rest, weights, clamped = None, 0, F.lit(False)
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * up
    while True:
        free = sources.agg(
            F.sum(F.when(~clamped, F.col("weight"))).alias("weights"), F.sum(F.when(clamped, cap)).alias("taken")
        ).first()
        left = total - (free["taken"] or 0) * down, free["weights"] or 0
        if left == (rest, weights):
            break
        rest, weights = left
        # weight / weights * rest / down > cap, in whole numbers.
        clamped = F.col("weight").cast(_WIDE) * F.lit(rest).cast(_NARROW) > cap.cast(_WIDE) * F.lit(
            weights * down
        ).cast(_NARROW)
    below = F.lit(max(weights, 1) * down)
    numerator = F.col("weight").cast(_WIDE) * F.lit(rest).cast(_NARROW)
    target = F.when(clamped, cap.cast("double")).otherwise(numerator.cast("double") / below.cast("double"))
    whole = F.expr("(2 * share + below) div (2 * below)")
    return (
        sources.withColumn("share", numerator)
        .withColumn("below", below.cast(_NARROW))
        .select("source", "source_size", target.alias("target"), F.when(clamped, cap).otherwise(whole).alias("goal"))
    )


def _same(a: Column, b: Column) -> Column:
    """Null equals null, in a form that joins by hash or sort."""
    return (F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))) & (a.isNull() == b.isNull())


def last_keys(rows: DataFrame, plan: DataFrame, rules: MixingRules = PRODUCTION) -> DataFrame:
    """Per source the key at which the fractional repetition ends, the words of rows with that
    key (``at_key``) and how many of these it still takes (``part``).

    Two steps look at ``step`` digits each, so the last one, over whole keys, reads one key in
    16 ** (2 * step) of a source.
    """
    open_ = plan.select(
        F.col("source").alias("its"), F.lit("").alias("prefix"), (F.col("goal") % F.col("source_size")).alias("part")
    )
    for step in (rules.step, 2 * rules.step, 32):
        known = 0 if step == rules.step else (rules.step if step == 2 * rules.step else 2 * rules.step)
        below = (
            rows.join(open_, _same(F.col("source"), F.col("its")) & (F.substring("key", 1, known) == F.col("prefix")))
            .groupBy("its", "part", F.substring("key", 1, step).alias("next"))
            .agg(F.sum("size").alias("at_key"))
        )
        upto = F.sum("at_key").over(Window.partitionBy("its").orderBy("next"))
        open_ = stored(
            below.select("*", upto.alias("upto"))
            .where((F.col("upto") > F.col("part")) & (F.col("upto") - F.col("at_key") <= F.col("part")))
            .select("its", F.col("next").alias("prefix"), (F.col("part") - F.col("upto") + F.col("at_key")).alias("part"), "at_key"),
            "open-keys",
        )
    return open_.withColumnRenamed("prefix", "last_key")


def mixed(
    docs: DataFrame,
    rules: MixingRules = PRODUCTION,
    *,
    record: str = "doc_id",
    source: str = "source",
    text: str = "text",
    size: str | None = None,
) -> DataFrame:
    """All columns plus size, source_size, target, whole (repetitions), partial (words of one
    more) and taken.  ``size`` names a column of sizes; without it the words of ``text`` count.
    """
    row = F.col("row")
    counted = row.getField(size).cast("long") if size else word_count(text_or_empty(row.getField(text)))
    sized = packed(docs).select(
        "row",
        row.getField(source).cast("string").alias("source"),
        F.coalesce(counted, F.lit(0)).alias("size"),
        seeded_key(row.getField(record), rules).alias("key"),
    )
    rows = stored(sized.select("source", "size", "key"), "sized-rows")
    plan = stored(targets(weighed(rows.groupBy("source").agg(F.sum("size").alias("source_size")), rules), rules), "targets")
    ends = last_keys(rows, plan.where("source_size > 0"), rules)
    # Stored, so that the join with the documents is planned by the size it really has.
    plan = stored(
        plan.join(ends, _same(F.col("source"), F.col("its")), "left").select(
            F.col("source").alias("of"), "source_size", "target", "last_key", "part", "at_key",
            F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(0).alias("whole"),
        ),
        "mix-plan",
    )
    partial = (
        F.when(F.col("key") < F.col("last_key"), F.col("size"))
        .when(
            F.col("key") == F.col("last_key"),
            F.expr("(cast(size as decimal(19,0)) * cast(part as decimal(18,0))) div at_key"),
        )
        .otherwise(0)
    )
    return with_result(
        sized.join(plan, _same(F.col("source"), F.col("of"))).withColumn("partial", partial),
        size=F.col("size"),
        source_size=F.col("source_size"),
        target=F.col("target"),
        whole=F.col("whole"),
        partial=F.col("partial"),
        taken=F.col("size") * F.col("whole") + F.col("partial"),
    )


def repeated(mix: DataFrame, *, text: str = "text") -> DataFrame:
    """The mix itself: every document as often as ``whole`` says, and once more with its first
    ``partial`` words; ``repetition`` counts from 0."""
    row = F.col("row")
    count = row.getField("whole") + F.when(row.getField("partial") > 0, 1).otherwise(0)
    rows = packed(mix).where(count > 0).select(
        "row", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("repetition")
    )
    words = F.regexp_extract_all(text_or_empty(row.getField(text)), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    beginning = F.array_join(F.slice(words, F.lit(1), row.getField("partial").cast("int")), " ")
    cut = (F.col("repetition") == row.getField("whole")) & (row.getField("partial") < row.getField("size"))
    return with_result(
        rows, **{text: F.when(cut, beginning).otherwise(row.getField(text)), "repetition": F.col("repetition")}
    )
