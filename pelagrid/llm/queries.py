"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagrid.llm import (
    chat,
    curriculum,
    decontaminate,
    feast,
    forest,
    fp_search,
    langid_ppm,
    licences,
    line_rules,
    oracles,
    quality_qda,
    sharding,
    url_tree,
    wrapper,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.perspectives(table(spark, sf_dir, "conversations")))


def op3_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_ppm.identify(table(spark, sf_dir, "documents"))


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    placed = curriculum.schedule(documents)
    first = F.round(F.get("copies", F.lit(0))["position"], 9)
    return placed.select(
        "doc_id", "size", "source_size", "target", "taken", first.alias("first_position")
    ).orderBy(F.asc_nulls_last("first_position"), "doc_id")


def op8_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.near_duplicates(table(spark, sf_dir, "documents"), forest.Forest(3, 85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op10_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(table(spark, sf_dir, "documents"))


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feast.components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_path_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_tree.judge(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_perspective_rotation": op1_perspective_rotation,
    "op2_template_decontamination": op2_template_decontamination,
    "op3_licence_rules": op3_licence_rules,
    "op4_label_propagation_shards": op4_label_propagation_shards,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_language_id": op6_language_id,
    "op7_curriculum_mix": op7_curriculum_mix,
    "op8_minhash_forest": op8_minhash_forest,
    "op9_wrapper_induction": op9_wrapper_induction,
    "op10_line_frequency_rules": op10_line_frequency_rules,
    "op11_feast_whitening": op11_feast_whitening,
    "op12_fp_tree_search": op12_fp_tree_search,
    "op13_path_template_tree": op13_path_template_tree,
}

ORACLES: dict[str, str] = oracles.ORACLES
