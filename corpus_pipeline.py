"""Stages that turn the documents table into training tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the
next stage's documents.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import bpe, pfair, probminhash, secrets, toxicity
from riskspark.llm.common import table
from riskspark.llm.queries import VOCABULARY
from riskspark.session import shared_dir


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from labels that are not held out, does not reject."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the least id."""
    return probminhash.representatives(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each secret replaced and ``n_chars`` made to agree."""
    return secrets.redacted(docs, secrets.fit(docs))


def in_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, the rows in the order in which blocks of the sources take their slots."""
    return pfair.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, in the order of the mixture.

    ``place`` grows along the mixture: the number of the stage before's file, and
    the row in it.  The rows are dealt by ranges of it and are in order in them.
    """
    name = F.col("_metadata.file_name")
    # part-<task>-<uuid>[-c|.c]<file of the task>...: two numbers, and the row.
    task = F.regexp_extract(name, r"^part-(\d+)-", 1).cast("long")
    file = F.regexp_extract(name, r"[.-]c(\d+)(?:\.[a-z][a-z0-9]*)?\.parquet$", 1).cast("long")
    placed = docs.select("doc_id", "text", F.struct(
        task.alias("task"), file.alias("file"), F.col("_metadata.row_index").alias("row")).alias("place"))
    ordered = placed.repartitionByRange("place").sortWithinPartitions("place")
    return bpe.encode_decode(ordered, VOCABULARY, keep="place").selectExpr(
        "place", "doc_id", "CAST(size(ids) AS BIGINT) AS n_tokens", "ids")


STAGES = [("toxicity", harmless), ("minhash_near_dedup", different), ("secret_scans", without_secrets),
          ("source_mixing", in_mixture), ("bpe_encoding", tokens)]

#: Learned models and token ids are outside SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the rows are on disk."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark, 'pipeline')}/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
