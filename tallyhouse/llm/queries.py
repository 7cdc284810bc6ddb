"""Registered queries of this subpackage: every operator over its whole table, and the pipeline's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import alignment, bpe_tree, exact_copies, line_rules, packing, phrases, quality, simhash, sql, syncmers, token_lengths, toxicity, url_templates, warc
from tallyhouse.llm.common import table

URL_RULES = [
    url_templates.Rule("net", "/", "block"), url_templates.Rule("example.net", "/en/", "allow"),
    url_templates.Rule("example.com", "/de/", "block"), url_templates.Rule("org", "/fr/", "allow"),
]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean_lines(table(spark, sf_dir, "documents")).drop("cleaned")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_pairs(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), syncmers.printed(F.col("sketch")).alias("fingerprint"),
        syncmers.printed(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe_tree.decode_ids(bpe_tree.encode_texts(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.suffix_sums(token_lengths.length_histogram(table(spark, sf_dir, "documents")))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_copies.mark_copies(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("text_digest")).alias("text_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_packing, op2_quality_rules, op3_toxicity, op4_fingerprints, op5_simhash, op6_quality_classifier, op7_warc, op8_bpe_tree, op9_url_filters, op10_token_counts,
              op11_alignment, op12_exact_dedup, op13_collocations)
}

# DuckDB has neither the tokenizers nor the learned models, nor XXH64 with a seed: the tests hold the
# other queries against brute force, exact round trips or held-out accuracy.
ORACLES: dict[str, str] = {
    "op2_quality_rules": sql.line_rules(),
    "op7_warc": sql.archives(),
    "op9_url_filters": sql.url_filters(URL_RULES),
    "op12_exact_dedup": sql.exact_copies(),
    "op13_collocations": sql.collocations(),
}
