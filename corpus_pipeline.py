"""From raw documents to token ids: good ones, one of each text, one of each group of near copies, no test items, pieces.

Every stage takes the table that the stage before wrote and keeps its columns; the last one returns id and pieces. Null texts
count as empty throughout and stay (they are the copies of each other, of which one stays). Empty tables pass through.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import decontaminate, exact_dedup, jaccard_join, nbsvm, piece_viterbi
from rollcall.llm.catalog import GENERATIONS, GOOD
from rollcall.llm.common import free_name, shared_dir, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores ``GOOD`` at least; it learns from all labels."""
    name = free_name(docs.columns, "score")
    scored = nbsvm.score(docs, nbsvm.fit(docs, table(spark, sf_dir, "labels")), name=name)
    return scored.filter(F.col(name) >= GOOD).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.keep_one(docs, exact_dedup.by_range(docs, GENERATIONS))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest id."""
    return jaccard_join.keep_one(docs)


def no_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document left, with the check that they decode to its text."""
    return piece_viterbi.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", no_test_items),
    ("SentencePiece encoding", pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
    return docs
