"""Registered queries: every operator on the synthetic reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.sequences import hamming, positions
from strandloom.operators import correct, downsample, extract, matrix, metrics, pairs, umi
from strandloom.plans.config import Correction, Segment
from strandloom.plans.tables import saved
from strandloom.sources import synthetic
from strandloom.sources.synthetic import PLAN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _extracted(spark: SparkSession, d: str) -> DataFrame:
    return extract.extract(synthetic.reads(spark, d), PLAN)


def _fixed(spark: SparkSession, d: str) -> DataFrame:
    return saved(correct.correct(saved(_extracted(spark, d)), PLAN, synthetic.whitelists(spark, d)))


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return correct.joined(_fixed(spark, d), PLAN, synthetic.annotation(spark))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return saved(umi.raw_counts(correct.valid(_joined(spark, d))))


def _molecules(spark: SparkSession, d: str) -> DataFrame:
    return umi.molecules(umi.assigned(_counts(spark, d), PLAN.umi_method, PLAN.umi_distance))


def _one(spark: SparkSession, d: str, s: Segment) -> DataFrame:
    reads = synthetic.reads(spark, d)
    return reads.select("sample", "read_id", extract.segment(F.col("r1_seq" if s.read == "R1" else "r2_seq"), s).alias("s")).select("sample", "read_id", "s.*")


@query
def reads_synth(spark, d):
    return synthetic.reads(spark, d)


@query
def hamming_distance(spark, d):
    return synthetic.reads(spark, d).select("read_id", hamming(F.substring("r2_seq", 1, 6), F.substring("r2_seq", 7, 6)).alias("distance"), hamming(F.col("r1_seq"), F.col("r2_seq")).alias("whole"))


@query
def linker_positions(spark, d):
    found = lambda k: F.array_join(positions(F.col("r1_seq"), "AGG", k).cast("array<string>"), ",")
    return synthetic.reads(spark, d).select("read_id", found(0).alias("exact"), found(1).alias("close"))


@query
def extract_fixed(spark, d):
    return _one(spark, d, Segment("X", "barcode1", "R1", 8, start=2))


@query
def extract_linker_right(spark, d):
    return _one(spark, d, Segment("X", "barcode1", "R1", 8, right="AGGTC"))


@query
def extract_linker_left(spark, d):
    return _one(spark, d, Segment("X", "barcode1", "R1", 2, left="AGG", linker_mismatch=1))


@query
def extract_linker_pair(spark, d):
    return _one(spark, d, Segment("X", "barcode1", "R1", 1, left="AG", right="TC"))


@query
def extract_fallback(spark, d):
    return _one(spark, d, PLAN.segments[0])


@query
def extract_reads(spark, d):
    return extract.flat(_extracted(spark, d), PLAN)


@query
def extraction_preview(spark, d):
    """Of each sample the 1000 first reads by number: the number of rows is the feature."""
    number = F.substring("read_id", 2, 20).cast("long")
    return correct.ranked(extract.flat(_extracted(spark, d), PLAN).withColumn("number", -number), "number", "read_id", 1000).drop("number", "rank")


@query
def extraction_stats(spark, d):
    return extract.stats(_extracted(spark, d), PLAN)


def _corrected(spark: SparkSession, d: str, c: Correction) -> DataFrame:
    s = Segment("CELL", "barcode1", "R1", 8, start=0, right="AGGTC", correction=c)
    raws = saved(_extracted(spark, d)).where("status = 'success'").select(F.col("CELL.raw").alias("raw"), correct.anchor(s).alias("anchor"))
    raws = raws.withColumn("anchor", F.when(F.length("raw") > 8, F.lit(1)).otherwise(F.lit(0)))
    return correct.corrected(raws, synthetic.whitelists(spark, d)["CELL"], s)


@query
def correct_exact(spark, d):
    return _corrected(spark, d, Correction(shift=0, mismatch=0))


@query
def correct_mismatch(spark, d):
    return _corrected(spark, d, Correction(shift=0, mismatch=1))


@query
def correct_mismatch_two(spark, d):
    return _corrected(spark, d, Correction(shift=0, mismatch=2))


@query
def correct_shift(spark, d):
    return _corrected(spark, d, Correction(shift=1, mismatch=0))


@query
def correct_full(spark, d):
    return _corrected(spark, d, Correction(shift=1, mismatch=1))


@query
def correct_ambiguous(spark, d):
    return _corrected(spark, d, Correction(shift=1, mismatch=1)).where("status = 'ambiguous'")


@query
def correct_disabled(spark, d):
    return _corrected(spark, d, Correction(enabled=False))


@query
def correction_trace(spark, d):
    return correct.trace(_fixed(spark, d), PLAN).drop("method")


@query
def correction_stats(spark, d):
    extracted = saved(_extracted(spark, d))
    fixed = saved(correct.correct(extracted, PLAN, synthetic.whitelists(spark, d)))
    return correct.stats(extracted, correct.trace(fixed, PLAN), correct.joined(fixed, PLAN, synthetic.annotation(spark)), PLAN)


@query
def valid_reads(spark, d):
    return correct.valid(_joined(spark, d))


@query
def annotation_gap(spark, d):
    return correct.annotation_gap(correct.trace(_fixed(spark, d), PLAN), PLAN, synthetic.annotation(spark))


@query
def raw_umi_counts(spark, d):
    return _counts(spark, d)


@query
def group_counts(spark, d):
    return _counts(spark, d).groupBy("sample").agg(F.count_distinct("barcode1", "barcode2_name").alias("groups"), F.sum("n").alias("reads"), F.count("*").alias("raw_umis"))


@query
def umi_unique(spark, d):
    return umi.assigned(_counts(spark, d), "unique")


@query
def umi_cluster(spark, d):
    return umi.assigned(_counts(spark, d), "cluster")


@query
def umi_directional(spark, d):
    return umi.assigned(_counts(spark, d), "directional")


@query
def umi_adjacency(spark, d):
    return umi.assigned(_counts(spark, d), "adjacency")


@query
def umi_components(spark, d):
    parts = umi.assigned(_counts(spark, d), "cluster")
    return parts.groupBy(*umi.GROUP, F.col("leader").alias("first_umi")).agg(F.count("*").alias("members"), F.sum("n").alias("reads"))


@query
def molecules(spark, d):
    return _molecules(spark, d)


@query
def matrix_long(spark, d):
    return matrix.long(_molecules(spark, d))


NAMES = sorted(k.upper() for k in synthetic.FEATURES if k != "signup")


@query
def matrix_dense(spark, d):
    return matrix.dense(matrix.long(_molecules(spark, d)), NAMES)


@query
def matrix_summary(spark, d):
    return matrix.summary(matrix.long(_molecules(spark, d)))


@query
def feature_totals(spark, d):
    return matrix.feature_totals(matrix.long(_molecules(spark, d)))


@query
def bulk_counts(spark, d):
    return matrix.bulk(matrix.long(_molecules(spark, d)), NAMES)


@query
def top_features(spark, d):
    """The 25 features with most molecules of each sample: a top-k report."""
    return correct.ranked(matrix.feature_totals(matrix.long(_molecules(spark, d))), "molecules", "barcode2_name", 25)


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of the r1 barcode and the raw r2 start, a molecule per feature sequence."""
    reads = synthetic.reads(spark, d).where(F.length("r1_seq") >= 8)
    parts = reads.select("sample", F.substring("r1_seq", 1, 8).alias("pb"), F.substring("r2_seq", 1, 6).alias("cb"), F.substring("r2_seq", 7, 6).alias("umi"))
    return saved(pairs.mapping(parts.groupBy("sample", "pb", "cb", "umi").agg(F.count("*").alias("reads_count"))))


def _kept(spark: SparkSession, d: str) -> DataFrame:
    found = _pairs(spark, d)
    return pairs.dominant(pairs.resolved(found, pairs.aliases(found, PLAN.min_parent_reads, PLAN.parent_child_ratio)), 0.05)


@query
def pair_mapping(spark, d):
    return _pairs(spark, d)


@query
def cb_aliases(spark, d):
    return pairs.aliases(_pairs(spark, d), PLAN.min_parent_reads, PLAN.parent_child_ratio)


@query
def pb_cb_resolved(spark, d):
    found = _pairs(spark, d)
    return pairs.resolved(found, pairs.aliases(found, PLAN.min_parent_reads, PLAN.parent_child_ratio))


@query
def pb_cb_map(spark, d):
    return _kept(spark, d)


@query
def cb_pb_counts(spark, d):
    return pairs.pbs_per_cb(_kept(spark, d))


@query
def cb_pb_distribution(spark, d):
    return pairs.distribution(pairs.pbs_per_cb(_kept(spark, d)))


@query
def pi_seq_filter(spark, d):
    return pairs.pi_filtered(pairs.pi_marked(_molecules(spark, d), 0.02))


@query
def pi_seq_qc(spark, d):
    return pairs.pi_qc(pairs.pi_marked(_molecules(spark, d), 0.02), 0.02)


def _thinned(spark: SparkSession, d: str) -> DataFrame:
    return saved(downsample.kept(_molecules(spark, d), PLAN))


@query
def downsample_counts(spark, d):
    return _thinned(spark, d)


@query
def downsample_metrics(spark, d):
    return downsample.metrics(_thinned(spark, d), PLAN)


@query
def optimal_point(spark, d):
    return downsample.optimal(downsample.metrics(_thinned(spark, d), PLAN))


@query
def optimal_detail(spark, d):
    thinned = _thinned(spark, d)
    return downsample.at_optimum(thinned, downsample.optimal(downsample.metrics(thinned, PLAN)))


@query
def optimal_matrix(spark, d):
    return matrix.long(optimal_detail(spark, d))


@query
def quick_test_lengths(spark, d):
    """Read lengths and share of N per sample; of equally frequent lengths the smallest."""
    return metrics.read_lengths(synthetic.reads(spark, d))


@query
def quick_test_metrics(spark, d):
    """What the quick test tells of each sample, here over all reads."""
    valid = saved(correct.valid(_joined(spark, d)))
    found = umi.molecules(umi.assigned(umi.raw_counts(valid), PLAN.umi_method, PLAN.umi_distance))
    return metrics.quick_metrics(synthetic.reads(spark, d), valid, found)


@query
def summary_meta(spark, d):
    extracted = saved(_extracted(spark, d))
    fixed = saved(correct.correct(extracted, PLAN, synthetic.whitelists(spark, d)))
    traced, all_reads = correct.trace(fixed, PLAN), saved(correct.joined(fixed, PLAN, synthetic.annotation(spark)))
    found = umi.molecules(umi.assigned(umi.raw_counts(correct.valid(all_reads)), PLAN.umi_method, PLAN.umi_distance))
    best = downsample.optimal(downsample.metrics(saved(downsample.kept(found, PLAN)), PLAN))
    gap = correct.annotation_gap(traced, PLAN, synthetic.annotation(spark))
    return metrics.summary_meta(correct.stats(extracted, traced, all_reads, PLAN), gap, best, PLAN)


@query
def summary_counts(spark, d):
    """Samples by features, from the matrix at the optimal point."""
    return matrix.bulk(optimal_matrix(spark, d), NAMES)


@query
def top_barcodes(spark, d):
    """The ten barcodes with most valid reads of each sample: a top-k report."""
    counts = valid_reads(spark, d).groupBy("sample", "barcode1").agg(F.count("*").alias("reads"))
    return correct.ranked(counts, "reads", "barcode1", 10)
