"""Sums over reads and molecules for the quick test and the summary over samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.plans.config import Plan


def read_lengths(reads: DataFrame) -> DataFrame:
    """Per sample: reads, shortest, longest and most frequent lengths of both mates (of equals the smallest), share of N."""
    n = lambda c: F.length(c) - F.length(F.replace(c, F.lit("N"), F.lit("")))
    sizes = reads.select("sample", F.length("r1_seq").alias("r1"), F.length("r2_seq").alias("r2"), (n("r1_seq") + n("r2_seq")).alias("ns"))
    kinds = (("min", F.min), ("max", F.max), ("mode", lambda c: F.mode(c, True)))
    ends = [f(mate).alias(f"{mate}_{kind}") for mate in ("r1", "r2") for kind, f in kinds]
    return sizes.groupBy("sample").agg(F.count("*").alias("reads"), *ends, F.round(F.sum("ns") / F.sum(F.col("r1") + F.col("r2")), 8).alias("n_base_rate"))


def molecule_sums(molecules: DataFrame) -> DataFrame:
    """Per sample: molecules, and the share of their reads that are repeats."""
    sums = molecules.groupBy("sample").agg(F.count("*").alias("deduplicated_molecules"), F.sum("reads_count").alias("n"))
    return sums.select("sample", "deduplicated_molecules", F.round((F.col("n") - F.col("deduplicated_molecules")) / F.col("n"), 8).alias("duplication_ratio"))


def quick_metrics(reads: DataFrame, valid: DataFrame, molecules: DataFrame) -> DataFrame:
    """A row per sample of the quick test: lengths, valid reads and their rate, molecules and duplication."""
    lengths = read_lengths(reads)
    good = valid.groupBy("sample").agg(F.count("*").alias("valid_reads"))
    whole = lengths.join(good, "sample", "left").join(molecule_sums(molecules), "sample", "left").na.fill(0, ["valid_reads", "deduplicated_molecules"])  # a row per sample each
    return whole.withColumn("valid_rate", F.round(F.col("valid_reads") / F.col("reads"), 6))


def summary_meta(corrections: DataFrame, gap: DataFrame | None, best: DataFrame, plan: Plan) -> DataFrame:
    """A row per sample of the summary: total reads, valid rates of segments, share of features with a name, the optimal point."""
    rate = lambda scope, column: F.max(F.when(F.col("scope") == scope, F.col(column)))
    segments = [rate(s.name, "valid_rate").alias(f"{s.name}_valid_rate") for s in plan.segments if s.corrected]
    named = F.coalesce(rate(f"final_{plan.names['barcode2']}", "valid_reads"), F.lit(0)).alias("named")
    sums = corrections.groupBy("sample").agg(F.max("total_reads").alias("total_reads"), *segments, named)
    lacking = F.lit(0).cast("long")
    if gap is not None:
        sums, lacking = sums.join(gap.groupBy("sample").agg(F.sum("reads_count").alias("lacking")), "sample", "left"), F.coalesce("lacking", F.lit(0))
    share = F.round(F.coalesce(F.try_divide(F.col("named").cast("double"), F.col("named") + lacking), F.lit(0.0)), 6)
    sums = sums.withColumn("annotated_rate", share).drop("named", "lacking")
    point = best.select("sample", F.col("ratio").alias("optimal_downsample_ratio"), "sequencing_saturation", "reads_sampled", "umi_types", "umi_detected_once", "duplication_ratio")
    return sums.join(point, "sample", "left")
