"""Count matrices and what is summed from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def long(molecules: DataFrame) -> DataFrame:
    """Molecules per sample, barcode1 and feature."""
    return molecules.groupBy("sample", "barcode1", "barcode2_name").agg(F.count("*").alias("molecules"))


def dense(counts: DataFrame, features: list[str]) -> DataFrame:
    """A row per barcode1, a column per feature in the given order, 0 where absent."""
    return counts.groupBy("sample", "barcode1").pivot("barcode2_name", features).agg(F.sum("molecules")).na.fill(0)


def summary(counts: DataFrame) -> DataFrame:
    """Barcodes, features and filled cells per sample."""
    return counts.groupBy("sample").agg(F.count_distinct("barcode1").alias("barcode1_count"), F.count_distinct("barcode2_name").alias("feature_count"), F.count("*").alias("nonzero_count"))


def feature_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("sample", "barcode2_name").agg(F.sum("molecules").alias("molecules"), F.count("*").alias("barcodes"))


def bulk(counts: DataFrame, features: list[str]) -> DataFrame:
    """A row per sample, a column per feature."""
    return counts.groupBy("sample").pivot("barcode2_name", features).agg(F.sum("molecules")).na.fill(0)
