"""A corpus pipeline of four stages over ``documents``.

language ID -> quality classifier -> n-gram Jaccard join -> packing. Each stage
is written as Parquet and read again by the next; all but the last return the
columns of documents. Stages learn from the rows they get (and, for quality,
from ``labels``); the trained statistics are those of that input.

Defined results. Empty input: every stage returns no rows. Rows with null or
letterless text leave at the first stage. Repeated ids: the rows of an id are
judged each; of a near-duplicate group one row stays, the one with the smallest
id (ties by text; a null id comes last). Columns beyond those of documents pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablight.llm.common import materialise, table
from tablight.llm.jaccard import near_duplicates
from tablight.llm.langid import UNDEFINED, fit_language_filter, predict_language
from tablight.llm.packing import pack
from tablight.llm.quality_pu import fit_quality, score_quality

#: A document stays if at least this share of its n-grams is of its language.
LANG_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letters, or mostly n-grams that no
    learned language has."""
    judged = predict_language(docs, fit_language_filter(docs), [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")])
    return judged.where((F.col("lang_pred") != UNDEFINED) & (F.col("score") >= LANG_SHARE)).select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the positive-unlabelled classifier calls bad."""
    model = fit_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), F.lit(True))
    judged = score_quality(docs, model, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")])
    # without any trusted positive there is nothing to judge by
    return (judged if model is None else judged.where("predicted = 1")).select("row.*")


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of near duplicates, the first by id (nulls last)
    and text. Rows are numbered in that order and joined by their number, so ids may
    repeat or be null; of equal rows any may be the first."""
    row = "_row"
    while row in {c.lower() for c in docs.columns}:
        row += "_"
    # equal rows are dealt by a random number, so that a row with many copies is not one task
    order = [F.col("doc_id").asc_nulls_last(), F.col("text"), F.col(row)]
    ordered = docs.withColumn(row, F.rand(7)).orderBy(*order)
    numbered = materialise(ordered.withColumn(row, F.monotonically_increasing_id()), "pipeline-numbered")
    first = near_duplicates(numbered, key=row).where(F.col(row) == F.col("component_id")).select(row)
    return numbered.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the surviving documents in sequences of 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicate_join", near_duplicate_join),
    ("packing", packing),
]
#: Learned models and tokenizers decide; tests hold the stages, not run() as a whole, against their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
