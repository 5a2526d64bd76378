"""Registered queries of this subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    best_fit,
    chosen_path,
    histogram_shards,
    language_fusion,
    parsed_phrases,
    periodic_runs,
    piece_agenda,
    quality_lines,
    secret_scan,
    stream_dedup,
    surrogates,
    url_rules,
    water_filling,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_line_first_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of line-first cleaning for every document."""
    return quality_lines.judged(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_lines", "kept_chars",
    )


def op10_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, representative and verdict of every document after the stateful stream."""
    result = stream_dedup.deduplicated(_table(spark, sf_dir, "documents"))
    return result.select(
        "doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256")
    )


def op7_entropy_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and sliding-window entropy."""
    result = secret_scan.scanned(_table(spark, sf_dir, "documents"))
    base = F.col("base_spans")
    return result.select(
        "doc_id",
        secret_scan.count_of(base, "assign").alias("n_assign"),
        secret_scan.count_of(base, "access").alias("n_access"),
        secret_scan.count_of(base, "hex").alias("n_hex"),
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def op2_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document under Jaccard similarity of shingles."""
    return chosen_path.joined(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of every piece of every document."""
    return best_fit.packed_pieces(_table(spark, sf_dir, "documents"))


def op4_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes over the order of doc_id."""
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return histogram_shards.sharded(rows).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_rarest_token_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judged(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def op5_piece_agenda_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    coded = piece_agenda.coded(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "agrees",
    )


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(docs).select("doc_id", "text", "n_entities")


def op3_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (by text and source) and every page (by all evidence)."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    model = language_fusion.fitted(docs, language_fusion.PRODUCTION, "text", "lang")
    nothing = F.lit(None).cast("string")
    number = F.lit(None).cast("bigint")
    records = docs.select(
        "doc_id", number.alias("page_id"), "text", nothing.alias("declared"), F.col("source").alias("host")
    ).unionByName(
        pages.select(
            number.alias("doc_id"),
            "page_id",
            language_fusion.visible_text(F.col("html")).alias("text"),
            language_fusion.declared_language(F.col("html")).alias("declared"),
            language_fusion.host_of(F.col("url")).alias("host"),
        )
    )
    return language_fusion.identified(records, model, keys=("doc_id", "page_id"))


def op11_parsed_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of every language."""
    return parsed_phrases.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))


def op12_capped_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, and the target of its source."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return water_filling.mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def _tiled(docs: DataFrame) -> DataFrame:
    """Texts of which every tenth (by the id's checksum) repeats a stretch of words to its end."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    docs = docs.select("doc_id", "text", checksum.alias("h"), F.when(checksum % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.expr("h div 10")
    at = (g % n).cast("int")
    period = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
    copies = F.ceil((n - at) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", at + 1, period), copies)), F.lit(1), n - at)
    tiled = F.array_join(F.concat(F.slice("words", F.lit(1), at), tail), " ")
    return docs.select("doc_id", F.when(n > 0, tiled).otherwise(F.col("text")).alias("text"))


def op13_maximal_pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document and its text without their repetitions, as digests."""
    found = periodic_runs.with_runs(_tiled(_table(spark, sf_dir, "documents")))
    listed = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""
    )
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_chosen_path_join": op2_chosen_path_join,
    "op3_language_fusion": op3_language_fusion,
    "op4_histogram_sort_shards": op4_histogram_sort_shards,
    "op5_piece_agenda_codec": op5_piece_agenda_codec,
    "op6_rarest_token_url_filter": op6_rarest_token_url_filter,
    "op7_entropy_secret_scan": op7_entropy_secret_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_line_first_quality": op9_line_first_quality,
    "op10_streaming_exact_dedup": op10_streaming_exact_dedup,
    "op11_parsed_phrases": op11_parsed_phrases,
    "op12_capped_water_filling": op12_capped_water_filling,
    "op13_maximal_pair_runs": op13_maximal_pair_runs,
}
