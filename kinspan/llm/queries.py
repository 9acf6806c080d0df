"""The thin queries over the operators of this subpackage, and the SQL that some of them are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinspan.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.decontamination import contaminated

    # the SQL joins by item_id, so it reports no item without one
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).where("item_id is not null").select("doc_id", "item_id", "n_shingles", "n_shared", "containment")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.quality_classifier import score

    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.sharding import kd_shards

    return kd_shards(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.ngram_join import ngram_groups

    return ngram_groups(table(spark, sf_dir, "documents"), shingle=3, num=90, den=100, lower=True).select("doc_id", "n_shingles", "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.mixing import pareto_mix

    return pareto_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinspan.llm.suffix_dedup import suffix_dedup

    return suffix_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_substring_dedup, op3_decontamination, op4_quality_classifier, op5_quality_rules, op6_sharding, op7_ngram_join, op8_mixing, op9_language_id, op10_suffix_dedup)}


def oracle_sql() -> dict[str, str]:
    from kinspan.llm import oracles

    return oracles.oracle_sql()
