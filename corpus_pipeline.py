"""A corpus pipeline: documents are filtered, cut, deduplicated, mixed and packed.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import linededup, minhash, mixing, packing, toxicity
from tallyhouse.llm.common import documents, table
from tallyhouse.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by all labelled ones, does not find toxic."""
    scored = toxicity.score(docs, docs, table(spark, sf_dir, "labels"), extra=["doc_id", "text", "lang", "source", "n_chars"])
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in their first document only; texts are cut, ids all stay."""
    cut = linededup.dedup_lines(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return minhash.keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.sample(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder."""
    docs = documents(spark, sf_dir)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
    return docs
