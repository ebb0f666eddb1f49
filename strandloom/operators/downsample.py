"""Reproducible downsampling and sequencing saturation.

Each supporting read of a molecule has a uniform number, made from an MD5 of seed,
repeat, molecule and the read's number in the molecule; a ratio keeps the reads below
it.  A molecule's kept reads are binomial at every ratio, as independent draws would
give; one number serves all ratios of a repeat, so reads are exploded once for each
repeat and not for each ratio, and the result doesn't depend on order or partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.plans.config import Plan

KEY = ["sample", "barcode1", "barcode2_name", "corrected_umi"]


def uniform(seed: int, repeat: Column, read: Column) -> Column:
    """A number from 0 to 1, below 1."""
    text = F.concat_ws(":", F.lit(str(seed)), repeat.cast("string"), *KEY, read.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def kept(molecules: DataFrame, plan: Plan) -> DataFrame:
    """KEY, ratio, repeat, reads: how many reads of each molecule are kept, zeros left out.

    One partial aggregate per repeat counts all ratios side by side.
    """
    inner = sorted(set(plan.ratios) - {0.0, 1.0})
    frames = [molecules.select(*KEY, F.lit(1.0).alias("ratio"), F.lit(0).alias("repeat"), F.col("reads_count").alias("reads"))]
    if inner:
        repeats = F.explode(F.sequence(F.lit(1), F.lit(plan.repeats))).alias("repeat")
        reads = molecules.select(*KEY, "reads_count", repeats).select(*KEY, "repeat", F.explode(F.sequence(F.lit(1).cast("long"), F.col("reads_count"))).alias("read"))
        drawn = reads.withColumn("u", uniform(plan.seed, F.col("repeat"), F.col("read")))
        counts = drawn.groupBy(*KEY, "repeat").agg(*[F.count_if(F.col("u") < r).alias(f"r{k}") for k, r in enumerate(inner)])
        each = F.array(*[F.struct(F.lit(r).alias("ratio"), F.col(f"r{k}").alias("reads")) for k, r in enumerate(inner)])
        frames.append(counts.select(*KEY, "repeat", F.inline(each)).select(*KEY, "ratio", "repeat", "reads"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.where("reads > 0")


def metrics(thinned: DataFrame, plan: Plan) -> DataFrame:
    """Per sample, ratio and repeat: reads, UMIs, singletons, duplication and saturation in percent."""
    spark = thinned.sparkSession
    grid = spark.createDataFrame(plan.grid, "ratio double, repeat int")
    points = thinned.select("sample").distinct().crossJoin(F.broadcast(grid))  # samples by the configured grid
    sums = thinned.groupBy("sample", "ratio", "repeat").agg(F.sum("reads").alias("reads_sampled"), F.count("*").alias("umi_types"), F.count_if(F.col("reads") == 1).alias("umi_detected_once"))
    whole = points.join(sums, ["sample", "ratio", "repeat"], "left").na.fill(0)
    duplication = F.try_divide(F.col("reads_sampled") - F.col("umi_types"), F.col("reads_sampled")) * 100
    saturation = (1 - F.try_divide(F.col("umi_detected_once"), F.col("umi_types"))) * 100
    return whole.withColumns({"duplication_ratio": F.round(F.coalesce(duplication, F.lit(0.0)), 6), "sequencing_saturation": F.round(F.coalesce(saturation, F.lit(0.0)), 6)})


def optimal(points: DataFrame) -> DataFrame:
    """Per sample the point of most saturation, of equals the smallest ratio, then repeat."""
    order = F.struct("sequencing_saturation", (-F.col("ratio")).alias("r"), (-F.col("repeat")).alias("k"))
    best = F.max_by(F.struct("ratio", "repeat", "reads_sampled", "umi_types", "umi_detected_once", "duplication_ratio", "sequencing_saturation"), order)
    return points.groupBy("sample").agg(best.alias("b")).select("sample", "b.*")


def at_optimum(thinned: DataFrame, best: DataFrame) -> DataFrame:
    """The molecules that the optimal point keeps, with their reads there."""
    point = F.broadcast(best.select("sample", "ratio", "repeat"))  # a row per sample
    return thinned.join(point, ["sample", "ratio", "repeat"]).select(*KEY, F.col("reads").alias("reads_count"))
