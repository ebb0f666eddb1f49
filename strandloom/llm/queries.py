"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import ann, bpe, exact_dedup, huffman, packing, quality, simhash, toxicity, url_filter, warc
from strandloom.llm.labelled import remainder
from strandloom.llm.runtime import Scratch, table

#: The rules of the URL query, longest match wins.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_quality_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = remainder("doc_id", 4) == 2
    scored = quality.score(docs, quality.train(docs, labels, ~held))
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")


def op2_exact_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = {"ids_crc32": F.crc32("ids")}
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), derived=crc)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op4")
    chunks = scratch.save(warc.archive(table(spark, sf_dir, "pages")), "archive")
    page = F.col("page").cast("long").alias("page_id")
    return warc.records(chunks).select(page, "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op5_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.Codec(table(spark, sf_dir, "documents"), bpe.Bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    both = codec.decode(codec.encode())
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_kmeans_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_huffman_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = huffman.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return back.select("doc_id", "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op9_toxicity_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = remainder("doc_id", 5) == 0
    scored = toxicity.score(docs, toxicity.train(docs, labels, ~held))
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted", "language_cut", "toxic")


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).drop("alias_verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_factorisation_machine, op2_exact_radix_dedup, op3_best_fit_packing, op4_warc_chunks, op5_simhash_multi_index,
        op6_byte_bpe, op7_kmeans_tree_search, op8_huffman_token_file, op9_toxicity_convolution, op10_url_rules,
    )
}
