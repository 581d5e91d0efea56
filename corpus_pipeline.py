"""The corpus pipeline: documents that are kept, without copies and benchmark questions, packed.

STAGES are (name, function) of (spark, docs, sf_dir). Each works on all that the one before has kept;
all but the last return the columns of documents. `run` writes what a stage returns as
Parquet in the shared folder and reads it again for the next; what a stage has staged on the way is deleted then.

Null, empty and repeated rows, and further columns of documents pass through a stage as its operator
defines; helper columns start with `_` and are dropped. Empty tables give empty tables.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import decontaminate, packing, quality, simhash
from dimflow.sources.staging import stage_alone


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1."""
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return docs.filter(quality.scorer(model)(F.col("text")) >= 0.3)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies: fingerprints of three-word shingles that
    lie within three bits, directly or through others."""
    return simhash.representatives(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without questions of the benchmark."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"), whole=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents and their places in sequences of 4096 ids."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_one_copy),
    ("decontaminate", keep_clean),
    ("pack", pack),
]

#: SQL has no means for a learnt classifier or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage_alone(spark, functools.partial(function, spark, docs, sf_dir))
    return docs
