"""Thin queries ``opN_<name>`` over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cover_tree, html_extract, language_id, license_scan, poisson_mix, quality_gam, sentencepiece_codec, url_filter, va_search
from .ngram_join import jaccard_components
from .scratch import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table. One of fewer parts than there are cores, as a small file is, is dealt out to all of them first."""
    rows, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "rule string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_components(table(spark, sf_dir, "documents"), words=3, num=90, den=100)
    return out.drop("part").withColumnRenamed("id", "doc_id")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), restore=True)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.link_vectors(table(spark, sf_dir, "embeddings"), 0.9)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", language_id.held_out(5, 0))
    featured = Scratch(spark).save(quality_gam.features(docs, ["doc_id", "held_out"]))
    labels = table(spark, sf_dir, "labels").where(~language_id.held_out(5, 0))
    return quality_gam.score(featured, quality_gam.train(featured, labels))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labelled = docs.where(~language_id.held_out(3, 1) & F.col("lang").isNotNull())
    return language_id.identify(docs.select("doc_id", language_id.held_out(3, 1).alias("held_out"), "text"), labelled, keep=["doc_id", "held_out"])


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.poisson_mix(table(spark, sf_dir, "documents"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_search.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_ngram_jaccard_join, op3_html_extraction, op4_sentencepiece, op5_license_scan,
        op6_embedding_dedup, op7_quality_classifier, op8_language_id, op9_source_mixing, op10_topk_search,
    )
}
ORACLES: dict[str, str] = {"op1_url_filter": url_filter.ORACLE, "op9_source_mixing": poisson_mix.ORACLE}
