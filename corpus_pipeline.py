"""A training-data pipeline: five operators, one after the other, over ``documents``.

A stage is a function of (spark, docs, sf_dir). Its result is written as
Parquet and read again as the next stage's ``docs``; all but the last return
the columns of documents. Every stage takes whole texts of any length, null
columns, repeated rows, further columns and an empty table, which stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bpe, line_quality, mixing, near_dup, toxicity
from tideline.llm.common import cut
from tideline.llm.queries import BPE_FILE, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that base rules and line labels keep. Null, empty and very
    short texts go; repeated rows are judged alike."""
    field = line_quality.train(docs, table(spark, sf_dir, "labels"))
    return line_quality.judge(docs, field).where("kept").select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't predicted toxic. Null and empty texts stay, as
    the score of a text without words is below the threshold; repeated rows are
    judged alike."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id. A
    document without words is a group of its own. Of a kept id one row stays for
    each of its texts; rows with a null id stay."""
    return near_dup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix, whole, those taken twice twice.
    Null sources are one source; texts without words are not taken."""
    return mixing.apply_mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the digest of what they decode to. Null and
    empty texts have no ids."""
    return bpe.round_trip(docs.select("doc_id", "source", "text"), BPE_FILE).select(
        "doc_id", "source", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("toxicity", clean), ("near_dup", distinct), ("mixing", mixed), ("bpe", encoded)]

#: The line field, the toxicity model and near copies have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
