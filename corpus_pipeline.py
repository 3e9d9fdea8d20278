"""Corpus pipeline: quality rules, exact de-duplication, near-duplicate join, source mixing,
packing. ``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import exact_dedup, ngram_join, packing, poisson_mix, rules_forest
from eventide.llm.common import materialize, read_table, without

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates of the pipeline (op9 has its own rule): five-word shingles, Jaccard 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = rules_forest.judge(docs, read_table(spark, sf_dir, "labels"), with_key=True)
    return without(docs, judged.where("NOT kept")).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(docs, words=NEAR_WORDS, percent=NEAR_PERCENT,
                                       with_key=True)
    return without(docs, found.where("NOT (doc_id <=> component_id)")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return poisson_mix.poisson_mix(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact),
          ("near_duplicates", near_duplicates), ("mix_sources", mix_sources),
          ("best_fit_packing", pack)]

#: Tokenisation and the forest cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
