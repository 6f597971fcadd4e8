"""One query per operator of this folder, over the whole of its table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm import (
    bestfit,
    html_blocks,
    language_masks,
    mixing,
    near_dups,
    pairwise_quality,
    periodic_runs,
    quality_rules,
    repair,
    secret_index,
    suffix_dedup,
    va_clustering,
    voronoi_knn,
)
from palate.llm.common import table


def op1_bestfit_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"))


def op2_language_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_masks.held_out())
    model = language_masks.train(docs.where(~F.col("held_out")))
    return language_masks.predict(docs, model, carry=("doc_id", "held_out"))


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.components(table(spark, sf_dir, "documents"), near_dups.Settings(words=2))


def op4_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    settings = repair.Settings(public_tokenizers.path("word_bpe_49k.json"))
    return repair.read_documents(repair.write_shards(table(spark, sf_dir, "documents"), settings))


def op6_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.summary(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op8_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_index.scan(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op11_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.digest(periodic_runs.find(docs, edit=periodic_runs.planted))


def op13_va_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clustering.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bestfit_bins,
        op2_language_masks,
        op3_near_dups,
        op4_voronoi_knn,
        op5_repair_shards,
        op6_hypergeometric_mix,
        op7_suffix_dedup,
        op8_secret_index,
        op9_quality_rules,
        op10_html_blocks,
        op11_pairwise_quality,
        op12_lyndon_runs,
        op13_va_centroids,
    )
}

ORACLES: dict[str, str] = {
    "op3_near_dups": near_dups.ORACLE_SQL,
    "op4_voronoi_knn": voronoi_knn.ORACLE_SQL,
    "op7_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op8_secret_index": secret_index.oracle_sql(),
    "op13_va_centroids": va_clustering.oracle_sql(),
}
