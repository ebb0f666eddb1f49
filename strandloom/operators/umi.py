"""Collapsing UMIs into molecules.

Order among UMIs is by count, largest first, then by sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.sequences import hamming, starred
from strandloom.plans.tables import saved

GROUP = ["sample", "barcode1", "barcode2_name"]
NODE = [*GROUP, "umi"]


def raw_counts(valid: DataFrame) -> DataFrame:
    """Reads per sample, barcode1, feature and raw UMI; partly aggregated before the shuffle."""
    return valid.groupBy(*NODE).agg(F.count("*").alias("n"))


def neighbours(counts: DataFrame, distance: int = 1) -> DataFrame:
    """Ordered pairs (umi, n) to (other, m) of one group within ``distance``, each pair both ways.

    At distances one and two both meet on a key with so many positions starred, so a
    group of any size is spread over its keys and all that meet are neighbours; above
    that they meet on one of distance + 1 equal blocks.
    """
    if distance <= 2:
        keys = F.explode(starred(F.col("umi"), distance)).alias("key")
    else:
        size = F.length("umi")
        cut = lambda k: F.floor(size * k / (distance + 1)).cast("int")
        blocks = [F.concat(F.lit(f"{k}:"), F.substr("umi", cut(k) + 1, cut(k + 1) - cut(k))) for k in range(distance + 1)]
        keys = F.explode(F.array(*blocks)).alias("key")
    left = counts.select(*NODE, "n", F.length("umi").alias("size"), keys)
    right = left.select(*GROUP, F.col("umi").alias("other"), F.col("n").alias("m"), "size", "key")
    met = left.join(right, [*GROUP, "size", "key"]).where("umi <> other")
    if distance > 2:
        met = met.where(hamming(F.col("umi"), F.col("other")) <= distance)
    if distance > 1:
        met = met.dropDuplicates([*NODE, "other"])
    return met.select(*NODE, "n", "other", "m")


def least_ancestor(counts: DataFrame, arrows: DataFrame) -> DataFrame:
    """counts with column leader, the first in order of all UMIs from which a UMI can be reached.

    ``arrows`` go from (umi, n) to (other, m).  Only UMIs that have arrows take part in
    the rounds.  Labels move along arrows, and a round also takes the label of the
    labelled one, so paths halve; what a UMI is told and what it holds meet in one
    aggregate, whose table is written to the shared folder.
    """
    rank = lambda n, umi: F.struct((-F.col(n)).alias("minus"), F.col(umi).alias("umi"))
    arrows = saved(arrows.select(*NODE, "n", "other", "m"))
    mine, none = F.col("label"), F.lit(None)
    start = arrows.select(*NODE, rank("n", "umi").alias("own"), rank("n", "umi").alias("label"))
    start = start.union(arrows.select(*GROUP, F.col("other").alias("umi"), rank("m", "other").alias("own"), F.least(rank("m", "other"), rank("n", "umi")).alias("label")))
    labels = saved(start.groupBy(*NODE).agg(F.min("own").alias("held"), F.min("label").alias("label")))
    while labels.where("label < held").head(1):
        held = labels.select(*NODE, "label")
        told = arrows.select(*NODE, "other").join(held, NODE).select(*GROUP, F.col("other").alias("umi"), none.cast(labels.schema["held"].dataType).alias("held"), "label")
        jumps = held.select(*GROUP, F.col("umi").alias("node"), F.col("label.umi").alias("umi")).where("node <> umi")
        jumped = jumps.join(held, NODE).select(*GROUP, F.col("node").alias("umi"), none.cast(labels.schema["held"].dataType).alias("held"), "label")
        all_told = held.select(*NODE, mine.alias("held"), "label").union(told).union(jumped)
        labels = saved(all_told.groupBy(*NODE).agg(F.min("held").alias("held"), F.min("label").alias("label")))
    found = labels.select(*NODE, F.col("label.umi").alias("leader"))
    return counts.join(found, NODE, "left").select(*NODE, "n", F.coalesce("leader", "umi").alias("leader"))


def assigned(counts: DataFrame, method: str = "directional", distance: int = 1) -> DataFrame:
    """counts with column leader, the UMI that each raw UMI belongs to."""
    if method == "unique":
        return counts.select(*NODE, "n", F.col("umi").alias("leader"))
    counts = saved(counts)
    near = neighbours(counts, distance)
    if method == "directional":
        return least_ancestor(counts, near.where("n >= 2 * m - 1"))
    near = saved(near)
    parts = least_ancestor(counts, near)
    return parts if method == "cluster" else _adjacency(parts, near)


def _adjacency(parts: DataFrame, near: DataFrame) -> DataFrame:
    """Per component: the fewest first UMIs that cover it; each other one belongs to its first neighbour.

    A UMI is covered once the first of itself and its neighbours leads.  So the last
    of these over a component says how far leads go, and no component meets in one task.
    """
    place = lambda n, umi: F.struct((-F.col(n)).alias("minus"), F.col(umi).alias("umi"))
    beside = near.groupBy(*NODE).agg(F.min(place("m", "other")).alias("beside"))
    own = parts.join(beside, NODE, "left").withColumn("own", place("n", "umi")).withColumn("cover", F.least("own", F.coalesce("beside", "own")))
    own = saved(own.select(*NODE, "n", "own", "cover", F.col("leader").alias("part")))
    last = own.groupBy(*GROUP, "part").agg(F.max("cover").alias("last"))
    return own.join(last, [*GROUP, "part"]).select(*NODE, "n", F.when(F.col("own") <= F.col("last"), F.col("umi")).otherwise(F.col("cover.umi")).alias("leader"))


def molecules(assignment: DataFrame) -> DataFrame:
    """A row per corrected UMI: its reads and how many raw UMIs it has."""
    return assignment.groupBy(*GROUP, F.col("leader").alias("corrected_umi")).agg(F.sum("n").alias("reads_count"), F.count("*").alias("raw_umi_count"))
