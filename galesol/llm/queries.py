"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from galesol.llm import lines, lloyd, minhash, oracles, packing, phrases, pieces, pii, quality_classifier, quality_rules, repeats, sharding, url_filter, vafile
from galesol.llm.common import documents, prepare


def op1_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op2_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.exact_top_k(prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5)


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(documents(spark, sf_dir))


def op4_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, sf_dir), sharding.QUERY_BYTES)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_quality_rules(documents(spark, sf_dir))


def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), share=85)


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.round_trip(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(documents(spark, sf_dir))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_classifier.described(documents(spark, sf_dir), ["doc_id"])
    model = quality_classifier.train(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.score_documents(rows, model)


def op11_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op12_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(prepare(spark).read.parquet(f"{sf_dir}/pages.parquet"))


def op13_dimension_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster_report(prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bootstrapped_pii,
        op2_va_file,
        op3_fuzzy_lines,
        op4_extendible_hashing,
        op5_quality_rules,
        op6_best_two_fit,
        op7_circulant_minhash,
        op8_merge_dropout,
        op9_repeated_substrings,
        op10_quality_classifier,
        op11_son_phrases,
        op12_path_templates,
        op13_dimension_lloyd,
        pipeline,
    )
}

ORACLES: dict[str, str] = oracles.ORACLES
