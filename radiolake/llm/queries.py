"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radiolake.llm import (
    collocations,
    decontamination,
    empirical_bayes,
    exact_dedup,
    hmm,
    license_scan,
    minhash,
    packing,
    pii,
    preference,
    quality_rules,
    sharding,
    turn_repair,
)
from radiolake.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is the host; the documents have no path, so the language stands for it."""
    ship_package(spark)
    return empirical_bayes.quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang")
    )


def op9_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return preference.format_preferences(turns, preference.neighbours(turns))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op1_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return hmm.scores(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.sharded(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"), license_scan.templates(spark))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return collocations.top_collocations(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return turn_repair.repair_report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hmm_scoring": op1_hmm_scoring,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_sharding": op3_sharding,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_pii": op5_pii,
    "op6_license_scan": op6_license_scan,
    "op7_decontamination": op7_decontamination,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_preference_formatting": op9_preference_formatting,
    "op10_quality_rules": op10_quality_rules,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_turn_repair": op13_turn_repair,
}
