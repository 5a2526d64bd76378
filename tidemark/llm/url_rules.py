"""URL filters: pattern rules found through their rarest literal token.

Every rule is a regular expression together with the literal tokens that any URL it fits
must contain; a rule of alternatives is one entry for each, under one name.  The corpus decides
which of these tokens is rarest; the rule is filed under it alone.  URL tokens are looked up in
that index by an equi-join, and only the rules they fetch run their expressions.  Common tokens
such as ``com`` therefore fetch few rules, and the work does not grow with the number of rules
times the number of URLs.

Rules are a table: ``rule_table`` makes one of rules written here, ``host_path_rules`` one of a
list of hosts and paths of any length (``listed_rules`` reads such a list from text files).  The
index is written once, so the optimizer knows its size and decides on that whether to send it
to all tasks or to shuffle.

Host and path rules (allow or block, longest wins) decide first; where none fits, any fitting
spam pattern blocks, and everything else is allowed.

Edge cases: a null URL or one without ``://`` has empty host and path, fits no rule and is
allowed.  Very long URLs are taken whole.  Of fitting rules of one length the last name wins.  A
rule without any token is tried on every URL; ``PRODUCTION`` has none.  An empty rule table
allows all.  Rows are told apart by a row number, so repeated and null identifiers are fine.  An
empty table gives an empty table; input columns named like a result are replaced by it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, stored, with_result

RULE_FIELDS = "name string, verdict string, pattern string, tokens array<string>, length int"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``tokens``: runs of letters and digits that every fitting URL contains as a whole."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    #: Host and path rules rank by length, before all patterns.
    length: int = 0


def host_path_rule(verdict: str, host: str, path: str) -> Rule:
    """A host with its subdomains and a path prefix, matched on host + path."""
    pattern = rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}"
    # A token of the path is complete only if something other than a letter follows it.
    whole = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower())
    tokens = tuple(dict.fromkeys(re.findall(r"[a-z0-9]+", host.lower()) + whole))
    return Rule(host + path, verdict, pattern, tokens, len(host + path))


# The host and path rules.
BASE_RULES = (
    host_path_rule("allow", "com", "/"),
    host_path_rule("block", "example.com", "/en/"),
    host_path_rule("allow", "www.example.com", "/en/"),
    host_path_rule("block", "net", "/es/"),
    host_path_rule("block", "net", "/fr/"),
)

SPAM_RULES = (
    Rule("cheap-pills", "block", r"(^|[.-])cheap-pills([.-]|/|$)", ("cheap", "pills")),
    Rule("online-casino", "block", r"(^|[./-])online-casino([./-]|$)", ("online", "casino")),
    Rule("free-download", "block", r"(^|[./-])free-downloads?([./-]|$)", ("free",)),
    Rule("payday-loans", "block", r"(^|[./-])payday-loans?([./-]|$)", ("payday",)),
    *[Rule("adult", "block", rf"(^|[./-]){word}[.-]", (word,)) for word in ("xxx", "porn", "adult")],
    Rule("tracker", "block", r"(^|[.])(track|click)[.].*[/]redirect", ("redirect",)),
    *[Rule("session", "block", rf"/{word}[/=-]", (word,)) for word in ("phpsessid", "jsessionid")],
)

PRODUCTION = BASE_RULES + SPAM_RULES


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.when(url.contains("://"), host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(url.contains("://"), path).otherwise(F.lit(""))


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    rows = [(r.name, r.verdict, r.pattern, list(r.tokens), r.length) for r in rules]
    return spark.createDataFrame(rows, RULE_FIELDS)


def host_path_rules(listed: DataFrame) -> DataFrame:
    """Rules of a table (verdict, host, path), like ``host_path_rule`` of each row.

    Rows without a verdict or a host are left out.  A null path is empty and fits every path.
    """
    host, path = F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))
    to_its_end = F.when(path == "", r"(?:/|\z)").otherwise("")
    literal = F.regexp_replace(F.concat(host, path), r"([^A-Za-z0-9/_])", r"\\$1")
    words = F.regexp_extract_all(host, F.lit("[a-z0-9]+"), F.lit(0))
    whole = F.regexp_extract_all(F.lower(path), F.lit("[a-z0-9]+(?=[^a-z0-9])"), F.lit(0))
    return listed.where(F.col("verdict").isNotNull() & (F.col("host") != "")).select(
        F.concat(host, path).alias("name"),
        "verdict",
        F.concat(F.lit(r"^(?:[^/?#]*\.)?"), literal, to_its_end).alias("pattern"),
        F.array_distinct(F.concat(words, whole)).alias("tokens"),
        F.length(F.concat(host, path)).alias("length"),
    )


def listed_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of text files with lines like ``block example.com/en/``; lines that start with
    ``#`` and lines of any other form are passed over."""
    line = r"^(allow|block)\s+([^/\s]+)(/\S*)?\s*$"
    part = [F.regexp_extract("value", line, k) for k in (1, 2, 3)]
    lines = spark.read.text(path).where(F.col("value").rlike(line))
    return host_path_rules(lines.select(*[v.alias(n) for v, n in zip(part, ("verdict", "host", "path"), strict=True)]))


def index_of(rules: DataFrame, by_token: DataFrame) -> DataFrame:
    """token, name, verdict, pattern, length: every rule under the token that fewest URLs have;
    rules without a token are filed under ''.  Ties go to the first token in order."""
    fields = ["name", "verdict", "pattern", "length"]
    entries = rules.select(*fields, F.explode_outer("tokens").alias("token")).distinct()
    in_use = entries.select("token").where(F.col("token").isNotNull()).distinct()
    counts = by_token.join(in_use, "token").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), F.coalesce("token", F.lit("")).alias("token")))
    filed = entries.join(counts, "token", "left").groupBy(*fields).agg(rarest.alias("rarest"))
    return filed.select(F.col("rarest.token").alias("token"), *fields)


def judged(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = PRODUCTION, *, url: str = "url") -> DataFrame:
    """All columns plus host, path, rule (host and path rules), pattern and verdict."""
    spark = pages.sparkSession
    base = stored(
        packed(pages).select("row", F.monotonically_increasing_id().alias("seq")).select(
            "row", "seq", host_of(F.col("row").getField(url)).alias("host"), path_of(F.col("row").getField(url)).alias("path"),
        ),
        "urls",
    )
    address = F.concat("host", "path")
    # Every URL also has the empty token, under which rules without literals are filed.
    tokens = F.array_distinct(F.concat(F.split(F.lower(address), "[^a-z0-9]+"), F.array(F.lit(""))))
    by_token = base.select("seq", address.alias("address"), F.explode(tokens).alias("token"))
    if not isinstance(rules, DataFrame):
        rules = rule_table(spark, rules)
    index = stored(index_of(rules, by_token), "url-rules")
    fits = by_token.join(index, "token").where(F.expr("address RLIKE pattern"))
    best = fits.groupBy("seq").agg(
        F.max(F.struct("length", "name", "verdict")).alias("best"),
    )
    decided = base.join(best, "seq", "left")
    is_rule = F.col("best.length") > 0
    return with_result(
        decided,
        host=F.col("host"),
        path=F.col("path"),
        rule=F.when(is_rule, F.col("best.name")),
        pattern=F.when(~is_rule, F.col("best.name")),
        verdict=F.coalesce(F.col("best.verdict"), F.lit("allow")),
    )
