"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import pin
from . import (
    collocations, decontaminate, filter_audit, jaccard, language, main_text, mixing, quality, rules, secret_links, suffix_dedup,
    suffix_tree, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "item_share", "answer_share")


def op4_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.digest(table(spark, sf_dir, "documents"))


def op5_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"))


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = mixing.with_size(table(spark, sf_dir, "documents")).select("doc_id", "source", "size")
    return mixing.mix_sources(pin(sized, "mix-sizes")).select("doc_id", "size", "source_size", "target", "taken")


def op9_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op10_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tag_path_text": op1_tag_path_text,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_latent_leaks": op3_latent_leaks,
    "op4_secret_links": op4_secret_links,
    "op5_ftrl_quality": op5_ftrl_quality,
    "op6_suffix_tree_scores": op6_suffix_tree_scores,
    "op7_warc_round_trip": op7_warc_round_trip,
    "op8_source_mix": op8_source_mix,
    "op9_weak_rules": op9_weak_rules,
    "op10_byte_language": op10_byte_language,
    "op11_filter_audit": op11_filter_audit,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_suffix_dedup": op13_suffix_dedup,
}
