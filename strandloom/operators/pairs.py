"""Pair maps, alias repair, dominance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.sequences import wildcards
from strandloom.plans.tables import saved


def mapping(molecules: DataFrame) -> DataFrame:
    """Molecules and reads per sample, pb and cb; ``molecules`` has sample, pb, cb, reads_count."""
    return molecules.groupBy("sample", "pb", "cb").agg(F.count("*").alias("molecule_count"), F.sum("reads_count").alias("reads_count"))


def aliases(pairs: DataFrame, min_parent_reads: int = 5, ratio: float = 10.0) -> DataFrame:
    """Rare cbs with exactly one far more frequent neighbour, at one mismatch or one N."""
    counts = saved(pairs.groupBy("sample", "cb").agg(F.sum("reads_count").alias("reads")))
    parents = counts.where(~F.col("cb").contains("N") & (F.col("reads") >= min_parent_reads))
    parents = parents.select("sample", F.col("cb").alias("parent"), F.col("reads").alias("parent_reads"), F.explode(wildcards(F.col("cb"))).alias("key"))
    ns = F.length("cb") - F.length(F.replace("cb", F.lit("N"), F.lit("")))
    keys = F.when(ns == 0, wildcards(F.col("cb"))).otherwise(F.array(F.replace("cb", F.lit("N"), F.lit("*"))))
    children = counts.where(ns <= 1).select("sample", "cb", "reads", ns.alias("ns"), F.explode(keys).alias("key"))
    met = children.join(parents, ["sample", "key"]).where((F.col("cb") != F.col("parent")) & (F.col("parent_reads") >= F.col("reads") * ratio))
    one = met.groupBy("sample", "cb", "reads", "ns").agg(F.count_distinct("parent").alias("parents"), F.min("parent").alias("corrected_cb"), F.min("parent_reads").alias("parent_reads_count"))
    return one.where("parents = 1").select(
        "sample", F.col("cb").alias("raw_cb"), "corrected_cb", F.col("reads").alias("raw_reads_count"), "parent_reads_count", F.when(F.col("ns") > 0, "n_wildcard").otherwise("hamming_1").alias("correction_type")
    )


def resolved(pairs: DataFrame, alias: DataFrame) -> DataFrame:
    """Pairs with each cb replaced by its alias, once, and summed again."""
    alias = alias.select("sample", F.col("raw_cb").alias("cb"), "corrected_cb")
    moved = pairs.join(alias, ["sample", "cb"], "left").withColumn("cb", F.coalesce("corrected_cb", "cb"))
    return moved.groupBy("sample", "pb", "cb").agg(F.sum("molecule_count").alias("molecule_count"), F.sum("reads_count").alias("reads_count"))


def dominant(pairs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The leading cb of each pb, if its share of the reads is above the threshold.

    Totals and leaders are aggregates, so a pb with very many cbs isn't sorted in one task.
    """
    lead = F.min_by(F.struct("cb", "molecule_count", "reads_count"), F.struct((-F.col("reads_count")).alias("r"), "cb")).alias("lead")
    per_pb = pairs.groupBy("sample", "pb").agg(lead, F.sum("molecule_count").alias("total_molecule_count"), F.sum("reads_count").alias("total_reads_count"))
    share = F.col("lead.reads_count") / F.col("total_reads_count")
    kept = per_pb.where(share > threshold)
    return kept.select("sample", "pb", "lead.cb", "lead.molecule_count", "lead.reads_count", "total_molecule_count", "total_reads_count", F.round(share, 6).alias("dominant_ratio"))


def pbs_per_cb(kept: DataFrame) -> DataFrame:
    return kept.groupBy("sample", "cb").agg(F.count_distinct("pb").alias("pb_count"))


def distribution(per_cb: DataFrame) -> DataFrame:
    return per_cb.groupBy("sample", "pb_count").agg(F.count("*").alias("cb_count"))


def pi_marked(molecules: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Per feature and UMI: its leading molecule, how many barcodes and reads there are, and whether the leader is kept.

    All are aggregates, so a UMI with very many barcodes isn't sorted in one task.
    """
    lead = F.min_by(F.struct("barcode1", "reads_count", "raw_umi_count"), F.struct((-F.col("reads_count")).alias("r"), "barcode1")).alias("lead")
    each = molecules.groupBy("sample", "barcode2_name", "corrected_umi").agg(lead, F.count("*").alias("barcodes"), F.sum("reads_count").alias("total"))
    return each.withColumn("kept", (F.col("barcodes") == 1) | (F.col("lead.reads_count") / F.col("total") > threshold))


def pi_filtered(marked: DataFrame) -> DataFrame:
    """One molecule per feature and UMI: the only one, or the dominant one."""
    return marked.where("kept").select("sample", "lead.barcode1", "barcode2_name", "corrected_umi", "lead.reads_count", "lead.raw_umi_count")


def pi_qc(marked: DataFrame, threshold: float = 0.8) -> DataFrame:
    many = F.col("barcodes") > 1
    counts = marked.groupBy("sample").agg(
        F.sum("barcodes").alias("total_molecules"), F.count("*").alias("total_fb_umis"), F.count_if(many).alias("multi_pi_fb_umis"),
        F.count_if(F.col("kept") & many).alias("dominant_multi_pi_fb_umis"), F.count_if("kept").alias("retained_molecules"),
    )
    share = lambda a, b: F.round(F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0)), 6)
    counts = counts.withColumn("removed_fb_umis", F.col("total_fb_umis") - F.col("retained_molecules"))
    return counts.withColumns({
        "multi_pi_ratio": share("multi_pi_fb_umis", "total_fb_umis"), "dominant_ratio": share("dominant_multi_pi_fb_umis", "multi_pi_fb_umis"),
        "mp_ratio": share("removed_fb_umis", "total_fb_umis"), "dominance_threshold": F.lit(float(threshold)),
    })
