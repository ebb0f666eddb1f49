"""Connected components by alternating stars over a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.runtime import Scratch, merged


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """``node, component`` for all ends of ``edges`` (columns a, b, any ordered type).

    ``component`` is the smallest node that can be reached.  Each round links the
    neighbours of every node to the smallest one, first the larger neighbours
    (large star), then the smaller ones (small star), until the edge set is a set
    of stars.  Rounds grow with the logarithm of the longest path.  Minima are
    partly aggregated before they are shuffled, and they are written before they
    are joined back, so a hub's edges can be split by the adaptive skew join.
    Self-loops and edges with a null end are ignored; no edges, no rows.
    """
    clean = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = scratch.save(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    mark, step = _mark(now), 0
    while mark[0]:
        step += 1
        both = now.union(now.select("b", "a"))
        least = scratch.save(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-large-{step}"
        )
        large = both.join(merged(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.save(large, f"{name}-half-{step}")
        least = scratch.save(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-small-{step}")
        small = (
            large.join(merged(least), "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a > b")
            .distinct()
        )
        after = scratch.save(small, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}", f"{name}-large-{step}", f"{name}-half-{step}", f"{name}-small-{step}")
        before, mark, now = mark, _mark(after), after
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set: equal sets give equal marks."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
