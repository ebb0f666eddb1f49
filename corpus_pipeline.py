"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), with ``docs`` what its predecessor kept, read
straight from its files, and all but the last return documents' columns.  Labels come from ``labels``; rows
held out by the classifiers' queries aren't learned from here either.  Null texts
count as empty and rows with null or repeated ids are judged as rows of their own;
an empty table runs through to an empty result.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import exact_dedup, packing, quality, simhash, toxicity
from strandloom.llm.labelled import remainder
from strandloom.llm.runtime import removed, scope, shared_dir, table, written

#: SQL can't express the classifiers' fitting.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return toxicity.drop_toxic(docs, model)


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return quality.drop_low_quality(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs, stored=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs, stored=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), derived={"ids_crc32": F.crc32("ids")}, stored=True)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", reject_toxic),
    ("quality", reject_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written as Parquet and read again.

    A stage's own tables go once its result is written, and a result once the next
    one is; the last stays for the caller.
    """
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scope(spark):
            made = stage(spark, docs, sf_dir)
            written(made, f"{folder}/{name}")
        if last:
            removed(spark, f"{folder}/{last}")
        docs, last = spark.read.schema(made.schema).parquet(f"{folder}/{name}"), name
    return docs
