"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (ctw, exact_dedup, hilbert_shards, line_windows, ngram_join, packing,
                          poisson_mix, qda, ranked_search, rules_forest, secret_scan,
                          spelling_variants, suffix_dedup)
from eventide.llm.common import materialize, read_table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), with_kept=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_forest.judge(read_table(spark, sf_dir, "documents"),
                              read_table(spark, sf_dir, "labels"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qda.classify(read_table(spark, sf_dir, "documents"),
                        read_table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(
        secret_scan.scan_secrets(read_table(spark, sf_dir, "documents")))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.lm_scores(read_table(spark, sf_dir, "documents"))


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written whole, so that the shuffle moves the documents and not only their ids
    mix = materialize(poisson_mix.poisson_mix(read_table(spark, sf_dir, "documents")), "mix")
    return mix.select("doc_id", "source", "copy", "shuffle_key").orderBy(
        "shuffle_key", "doc_id", "copy")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_windows.line_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed",
                      F.sha2("text", 256).alias("kept_sha256"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=85)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(read_table(spark, sf_dir, "documents"),
                                       read_table(spark, sf_dir, "benchmark"))


def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.shard_digest(
        hilbert_shards.shard_documents(read_table(spark, sf_dir, "documents")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_quality_rules, op3_quality_classifier, op4_secret_scan,
    op5_best_fit_packing, op6_lm_scoring, op7_poisson_mix, op8_line_dedup,
    op9_ngram_jaccard_join, op10_exact_dedup, op11_ranked_search, op12_hilbert_shards,
    op13_spelling_variants)}

ORACLES: dict[str, str] = {
    "op7_poisson_mix": poisson_mix.ORACLE_SQL,
    "op8_line_dedup": line_windows.ORACLE_SQL,
    "op10_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_ranked_search": ranked_search.ORACLE_SQL,
}
