"""From raw documents to a tokenised training mix in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and reread as the next one's docs.
All but the last return the columns of documents. A stage works on every row that the one before it kept, and keeps
columns of any name and their values. Empty tables give empty ones; very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import language_id, poisson_mix, quality_gam, sentencepiece_codec
from skyledger.llm.ngram_join import jaccard_components
from skyledger.llm.queries import table
from skyledger.llm.scratch import Scratch, fresh, released

LEAST_LANGUAGE_SCORE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted with a posterior of at least a half.

    Those without a letter go: null and empty texts too. Without any labelled language all go. Repeated rows are judged alike.
    """
    pred, score = fresh("lang_pred", docs), fresh("score", docs)
    labelled = docs.where("lang is not null").select("doc_id", "text", "lang")
    return language_id.identify(docs, labelled).where((F.col(pred) != "und") & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier fitted on the labels predicts as quality 1. Null and empty texts are scored like others; repeated rows alike."""
    predicted = fresh("predicted", docs)
    model = quality_gam.train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.classify(docs, model).where(F.col(predicted) == 1).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by a Jaccard similarity of 0.8 of five-word shingles: the one with the smallest id, a null id being the largest.

    Of repeated rows, and of rows with one id in the same group, one stays. Texts without words have no shingles and all stay.
    """
    row = fresh("row", docs, ["id", "n_shingles", "component_id", "part"])
    numbered = Scratch(spark).save(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = jaccard_components(numbered, words=5, num=80, den=100, keep=[row])
    first = groups.where("part is not null").groupBy("part").agg(F.min_by(row, F.struct(F.col("id").isNull(), "id", row)).alias(row))
    stay = first.select(row).unionByName(groups.where("part is null").select(row))
    return numbered.join(stay, row, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources come near their target weights, in a global shuffle. Rows of one id are repeated alike; a null source is a source."""
    return poisson_mix.poisson_mix(docs).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document in place of its text, and whether decoding them gives the text again. A null text has null ids."""
    return sentencepiece_codec.encode(docs, restore=True)


STAGES = [
    ("language_id", keep_known_language),
    ("quality_classifier", keep_good_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("sentencepiece", tokenize),
]

#: SQL has no way to say the models, the near duplicates or the pieces.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES[:-1]:
        with released():
            docs = scratch.save(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
