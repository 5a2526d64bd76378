"""Language identification by Bayesian evidence fusion.

The posterior of a record's language is proportional to

    text likelihood * likelihood of the declared markup language
    * likelihood of the address suffix * prior of its host.

* Text: multinomial model of hashed character trigrams per language, fitted on a bounded
  sample of labelled documents (``sample_per_language``).  Neighbouring trigrams are not
  independent, so a long text counts as ``most_trigrams`` of them at most.
* Declared language and country suffix: error rates; absent or unknown ones say nothing.
* Host: every record contributes the language shares that its own text and markup give.
  Grouped sums of these shares per host and per domain are smoothed hierarchically: a host's
  shares towards its domain's, a domain's towards those of all records.  A record's own
  contribution is taken out of its prior.

Every record is scored whole; sums cover all records.  Sums per host are combined before the
shuffle, so a host with a third of all records is one row per task.

Edge cases: null and blank texts have no text evidence; records without an address have the
overall prior; records without any evidence get the most common language; equal scores go to
the language first in alphabetical order.  Repeated rows are separate records.  An empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored, text_or_empty

# Main language of country suffixes.
SUFFIX_LANGUAGE = {
    "de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "co": "es", "cl": "es",
    "pe": "es", "uk": "en", "us": "en", "au": "en", "nz": "en", "ie": "en",
}


@dataclass(frozen=True)
class FusionRules:
    sample_per_language: int = 2000
    buckets: int = 1 << 15
    pseudo_count: float = 0.5
    most_trigrams: int = 150
    #: Share of declared languages and of country suffixes that mislead.
    markup_error: float = 0.15
    suffix_error: float = 0.3
    #: Records that the level above counts for.
    host_smoothing: float = 20.0
    domain_smoothing: float = 50.0


PRODUCTION = FusionRules()


def trigrams(text: str, buckets: int) -> np.ndarray:
    """Hashed trigrams of the letters and blanks of a text."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    letter = (points >= 97) & (points != 215) & (points != 247) & ((points <= 122) | (points >= 192))
    points = np.where(letter, points, np.uint64(32))
    points = points[np.append(True, (points[1:] != 32) | (points[:-1] != 32))]
    if len(points) < 3:
        return np.empty(0, np.int64)
    mixed = (points[:-2] * np.uint64(1 << 42) + points[1:-1] * np.uint64(1 << 21) + points[2:]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % buckets


def fitted(labelled: DataFrame, rules: FusionRules, text: str, language: str) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log probabilities by bucket, from a bounded sample.

    The rows of the sample are chosen by a hash of their content, so it does not depend on
    how the table is split.
    """
    rows = labelled.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(
        F.col(language).alias("language"), F.col(text).alias("text")
    )
    totals = {r["language"]: r["count"] for r in rows.groupBy("language").count().collect()}
    if not totals:
        return [], np.zeros((0, rules.buckets))
    keep = F.lit(False)
    for name, n in totals.items():
        limit = int(min(1.0, rules.sample_per_language / n) * 1_000_000)
        keep = keep | ((F.col("language") == name) & (F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < limit))
    buckets = rules.buckets

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch["language"], batch["text"], strict=True):
                sums.setdefault(name, np.zeros(buckets, np.int64))
                sums[name] += np.bincount(trigrams(t, buckets), minlength=buckets)
        for name, values in sums.items():
            at = np.flatnonzero(values)
            yield pd.DataFrame({"language": name, "bucket": at, "n": values[at]})

    counted = rows.where(keep).mapInPandas(count, "language string, bucket long, n long")
    counts = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(totals)
    table = np.full((len(languages), buckets), rules.pseudo_count)
    for k, name in enumerate(languages):
        own = counts[counts["language"] == name]
        table[k, own["bucket"]] += own["n"]
    return languages, np.log(table / table.sum(axis=1, keepdims=True))


def _text_scores(table: np.ndarray, rules: FusionRules):
    small, buckets, most = table.astype(np.float32), rules.buckets, rules.most_trigrams

    @F.pandas_udf("array<double>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        by_bucket = np.ascontiguousarray(small.T)
        for batch in texts:
            out = []
            for t in batch:
                found = trigrams(t or "", buckets)
                total = by_bucket[found].sum(axis=0, dtype=np.float64)
                out.append((total * (min(len(found), most) / max(len(found), 1))).tolist())
            yield pd.Series(out)

    return score


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles, comments, navigation and tags."""
    dropped = F.regexp_replace(html, r"(?is)<(script|style|nav|head)\b.*?</\1>|<!--.*?-->", " ")
    plain = F.regexp_replace(dropped, r"<[^>]*>", " ")
    return F.regexp_replace(plain, r"&[a-zA-Z]+;|&#\d+;", " ")


def declared_language(html: Column) -> Column:
    return F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang=["']?([a-zA-Z]{2,3})""", 1))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"://([^/?#:]*)", 1))


def _log_match(value: Column, known: list[str], languages: list[str], error: float) -> Column:
    """Log likelihoods of a claimed language for each language; 0 if the claim is unknown."""
    others = max(1, len(languages) - 1)
    right, wrong = float(np.log(1 - error)), float(np.log(error / others))
    return F.array(
        *[
            F.when(value.isin(known), F.when(value == name, right).otherwise(wrong)).otherwise(0.0)
            for name in languages
        ]
    )


def _shares(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    return weights


def identified(
    records: DataFrame,
    model: tuple[list[str], np.ndarray],
    rules: FusionRules = PRODUCTION,
    *,
    keys: tuple[str, ...],
    text: str = "text",
    declared: str = "declared",
    host: str = "host",
) -> DataFrame:
    """``keys``, language, confidence and text_language of every record.

    ``declared`` is the markup language or null, ``host`` the host name or null.
    """
    languages, table = model
    if not languages:
        return records.select(
            *keys,
            *[F.lit(None).cast(t).alias(n) for n, t in (("language", "string"), ("confidence", "double"), ("text_language", "string"))],
        )
    n = len(languages)
    names = F.array(*[F.lit(x) for x in languages])
    suffix = F.substring_index("host", ".", -1)
    suffix_language = F.lit(None).cast("string")
    for name in languages:
        own = [s for s, lang in SUFFIX_LANGUAGE.items() if lang == name]
        if own:
            suffix_language = F.when(suffix.isin(own), name).otherwise(suffix_language)
    base = records.select(
        *keys,
        F.when(F.col(host) != "", F.lower(F.col(host))).alias("host"),
        F.col(declared).alias("declared"),
        _text_scores(table, rules)(text_or_empty(text)).alias("text_log"),
    )
    base = base.withColumns(
        {
            "domain": F.substring_index("host", ".", -2),
            "claims": F.zip_with(
                _log_match(F.coalesce("declared", F.lit("")), languages, languages, rules.markup_error),
                _log_match(F.coalesce(suffix_language, F.lit("")), languages, languages, rules.suffix_error),
                lambda a, b: a + b,
            ),
        }
    )
    base = base.withColumn("own", F.zip_with("text_log", "claims", lambda a, b: a + b))
    base = base.withColumn("weights", _shares(F.col("own")))
    base = base.withColumn("weight", F.aggregate("weights", F.lit(0.0), lambda a, x: a + x))
    base = base.withColumn("shares", F.transform("weights", lambda x: x / F.col("weight")))
    base = stored(base.select(*keys, "host", "domain", "text_log", "own", "shares"), "language-evidence")

    sums = [F.sum(F.get("shares", F.lit(k))).alias(f"s{k}") for k in range(n)]
    again = [F.sum(f"s{k}").alias(f"s{k}") for k in range(n)]
    by_host = stored(base.groupBy("host", "domain").agg(F.count(F.lit(1)).alias("n"), *sums), "language-hosts")
    by_domain = by_host.groupBy("domain").agg(F.sum("n").alias("n"), *again)
    overall = by_host.agg(F.sum("n").alias("n"), *again).first()
    total = max(float(overall["n"] or 0), 1.0)
    prior = [(float(overall[f"s{k}"] or 0) + 1.0) / (total + n) for k in range(n)]
    a_host, a_domain = rules.host_smoothing, rules.domain_smoothing
    domain = by_domain.where("domain IS NOT NULL").select(
        "domain",
        F.array(*[(F.col(f"s{k}") + a_domain * prior[k]) / (F.col("n") + a_domain) for k in range(n)]).alias("domain_prior"),
    )
    hosts = (
        by_host.where("host IS NOT NULL")
        .join(domain, "domain")
        .select("host", F.col("n").alias("host_n"), F.array(*[F.col(f"s{k}") for k in range(n)]).alias("host_sum"), "domain_prior")
    )
    joined = base.join(hosts, "host", "left")
    log_prior = F.array(
        *[
            F.when(F.col("host_n").isNull(), F.lit(float(np.log(prior[k])))).otherwise(
                F.log(
                    (
                        F.greatest(F.get("host_sum", F.lit(k)) - F.get("shares", F.lit(k)), F.lit(0.0))
                        + a_host * F.get("domain_prior", F.lit(k))
                    )
                    / (F.col("host_n") - 1 + a_host)
                )
            )
            for k in range(n)
        ]
    )
    joined = joined.withColumn("log_prior", log_prior)
    joined = joined.withColumn("score", F.zip_with("own", "log_prior", lambda a, b: a + b))
    joined = joined.withColumn("posterior", _shares(F.col("score")))
    best = F.get(names, (F.array_position("score", F.array_max("score")) - 1).cast("int"))
    by_text = F.get(names, (F.array_position("text_log", F.array_max("text_log")) - 1).cast("int"))
    return joined.select(
        *keys,
        best.alias("language"),
        F.round(1.0 / F.aggregate("posterior", F.lit(0.0), lambda a, x: a + x), 6).alias("confidence"),
        by_text.alias("text_language"),
    )
