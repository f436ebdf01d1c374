"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it kept, and returns
the columns that it was given; the last returns the packed pieces. ``run`` writes every stage as
Parquet in the shared folder that the session names and reads it again for the next.

What holds for all stages: a table without rows gives one without rows; repeated rows and rows
without an id are kept or dropped by their own text; columns beyond those of ``documents`` are
carried along untouched, whatever their names. Each stage says what it does with null, empty and
very long texts and with ties.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.llm.frames import IdFilter, cut, shared_folder
from glossmill.llm.jaccard import similar_documents
from glossmill.llm.langid import UNKNOWN, identify
from glossmill.llm.packing import pack
from glossmill.llm.substring import substring_dedup
from glossmill.llm.surrogates import surrogates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _keeps_columns(stage: Stage) -> Stage:
    """The stage sees its own columns and others under names that clash with nothing; what comes
    back has the columns that were given, in their order."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = [c if c in COLUMNS else f"other_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inside), sf_dir).select(*inside).toDF(*docs.columns)

    return run


def _rest(docs: DataFrame, *own: str) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c not in own)


#: A language is told if its score exceeds what n languages have by chance, 1 / n, by this factor.
ABOVE_CHANCE = 1.05


@_keeps_columns
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents in which no language can be told go.

    Those are texts that are null, empty or without a letter, and texts whose best language scores
    no more than ``ABOVE_CHANCE`` times what chance gives it; with a single language there is no chance
    to exceed. A text of any length is read whole; equal scores go to the language that sorts first;
    repeated rows stay or go together.
    """
    found = identify(docs, carry=_rest(docs, "doc_id"))
    n = docs.agg(F.count_distinct("lang").alias("n")).first()["n"]
    told = F.col("lang_pred") != UNKNOWN
    return found.where(told & (F.col("score") > ABOVE_CHANCE / n) if n > 1 else told)


@_keeps_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4 on five words at 0.8: the document with the smallest id of each group stays.

    Null and empty texts resemble nothing and stay; texts of any length are compared whole; rows
    of one id are one document and stay or go together; rows without an id stay.
    """
    groups = similar_documents(docs, words=5, percent=80)
    gone = cut(groups.where("component_id <> doc_id").select("doc_id").distinct())
    # Only rows that may go are shuffled to meet the ids that do.
    known = IdFilter(gone, "doc_id")
    left = known.passing(docs).join(gone, "doc_id", "left_anti").select(*docs.columns)
    return known.passing(docs, inside=False).unionByName(left)


@_keeps_columns
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: words under a 13-word passage that an earlier document holds go; documents
    with nothing left go. Documents that lose nothing keep their text as it was.

    Null and empty texts lose nothing and stay; of equal passages the smallest id keeps its own;
    rows of one id take nothing from each other; rows without an id neither give nor lose.
    """
    kept = substring_dedup(docs, window=13, carry=_rest(docs, "doc_id", "n_chars"))
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    out = kept.where((F.col("n_removed") == 0) | (F.col("kept_text") != "")).withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast("long"))


@_keeps_columns
def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: personal data gives way to surrogates.

    All rows stay; null and empty texts stay as they are; equal values get equal surrogates
    everywhere, so equal texts stay equal.
    """
    return surrogates(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces of at most 1024 tokens in sequences of that length.

    A null or empty text is its end token; a long one is cut into full windows first; of equally
    long pieces the smaller id is placed first; repeated rows are packed as often as they occur.
    """
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("private_data", private_data),
    ("packing", packing),
]

#: The tokens of the last stage and the surrogates of the fourth are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
