"""Training corpus pipeline over ``documents``: toxicity, line dedup, SimHash
near-dedup, mixing to target weights, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``. Empty tables, null columns, very long
texts and repeated rows pass through every stage as its operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.byte_bpe import decode, encode
from strata.llm.common import stage, table
from strata.llm.line_dedup import dedup_lines
from strata.llm.mixing import Mix
from strata.llm.simhash import keep_one
from strata.llm.toxicity import reject


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (fitted on ``labels``) does not reject."""
    return reject(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-equal lines one line stays; rows stay."""
    return dedup_lines(spark, docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents the smallest ``doc_id`` stays."""
    return keep_one(spark, docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document and pass with the words that the mix takes."""
    return Mix(spark, docs).documents()


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's ids (little-endian unsigned 32-bit), their number, the digest
    of the decoded bytes and whether they are the text's."""
    coded = decode(encode(docs.select("doc_id", "source", "text")))
    return coded.select(
        "doc_id", "source", "token_ids",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources to target weights", mixing),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: SQL cannot train the classifier or draw the mix; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(spark, step(spark, docs, sf_dir), name.split()[0])
    return docs
