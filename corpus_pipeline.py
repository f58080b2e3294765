"""From raw documents to packed training sequences: five stages, each one of the corpus operators.

Each stage takes all that the one before it kept, is written as Parquet to the shared folder and read again by the next.
All but the last return the columns of documents, other columns are dropped. Every stage takes rows without an id, rows
that share one and repeated rows one by one unless it says otherwise, and gives an empty frame for an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icuflow.llm import line_dedup, minhash, packing, quality, secrets
from icuflow.llm.common import small_batches, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _measured(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels that are not held out, takes for good.

    Null and empty texts have no terms: they score 0.5, below the threshold, and go. Without labels every text does.
    """
    small_batches(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.classify(docs.select(COLUMNS), model).where("predicted = 1").select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that others share. A null text becomes an empty one; no document is dropped."""
    return _measured(line_dedup.drop_shared_lines(docs.select(COLUMNS)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id; classes without an id keep one too.

    Equal texts are one class, null and empty ones together; of repeated rows one stays, of rows that share an id those of
    other classes.
    """
    small_batches(spark)
    return minhash.firsts(docs.select(COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its secrets replaced by a mark. A null text becomes an empty one."""
    return _measured(secrets.redact(secrets.scan(docs.select(COLUMNS))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 1024 tokens. A null or empty text is the end id alone."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("minhash near-dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("best-fit packing", pack_sequences),
]

#: The classifier, the signatures and the tokens can't be expressed in SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs)
    return docs
