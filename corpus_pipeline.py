"""Corpus pipeline: quality rules, near copies, repeated passages, source mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``; each works on all
that the one before kept, and its decisions take effect:

* ``quality``: documents that the weak-supervision rules reject go.
* ``near_copies``: of each class of near copies the document with the least id stays.
* ``repeats``: bytes of passages that also stand in a document with a smaller id go; ``n_chars`` follows the text.
* ``mix``: each document as often as the mix takes it.
* ``pack``: the pieces of the packed sequences.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import jaccard_join, mixing, packing, quality, suffix_dedup
from casebook.llm._common import shared_folder, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.distinct_documents(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stripped = suffix_dedup.strip(docs)
    if "n_chars" not in docs.columns:
        return stripped
    kind = docs.schema["n_chars"].dataType
    return stripped.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, reuse=False)


STAGES = [
    ("quality", good_documents),
    ("near_copies", without_near_copies),
    ("repeats", without_repeats),
    ("mix", mixed),
    ("pack", packed),
]

# Near copies by tries, suffix arrays and dynamic programming have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
