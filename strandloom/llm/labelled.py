"""Bounded samples of labelled rows, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.runtime import text_of


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def known(labels: DataFrame, label: str, usable: Column, id_col: str = "doc_id") -> DataFrame:
    """id_col and y of each usable id with a label, of repeated ones the largest."""
    return labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & usable).groupBy(id_col).agg(F.max(label).cast("int").alias("y"))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    usable: Column,
    rows: dict[int, int],
    id_col: str = "doc_id",
    text_col: str = "text",
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """id_col, text, y, and columns ``also``, of at most ``rows[y]`` labelled ids of each class y, drawn by a hash of the id.

    ``usable`` says which ids may be learned from.  Repeated labels of an id count
    as the largest, rows with a null label not at all.  Of rows of ``docs`` that
    share an id one is learned from: the first by a hash of all that is taken.
    """
    all_known = known(labels, label, usable, id_col)
    drawn = None
    for y, most in rows.items():
        part = all_known.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(most)
        drawn = part if drawn is None else drawn.union(part)
    taken = docs.select(F.col(id_col), text_of(text_col).alias("text"), *[c.alias(k) for k, c in (also or {}).items()])
    met = taken.join(F.broadcast(drawn), id_col)  # drawn: the sum of ``rows`` at most
    names = ["text", *(also or {})]
    place = F.struct(F.xxhash64(*names).alias("h"), *names)
    one = met.groupBy(id_col, "y").agg(F.min(place).alias("one"))  # partly aggregated, so many copies of an id don't meet in one task
    return one.select(id_col, "y", *[f"one.{c}" for c in names])


def platt(logit, y):
    """Slope and shift (Newton steps, lightly regularised) that make logits probabilities."""
    import numpy as np

    x = np.stack([logit, np.ones_like(logit)], 1)
    w = np.array([1.0, 0.0])
    prior = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + (w - prior)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        w = w - np.linalg.solve(h, g)
    return max(float(w[0]), 0.05), float(w[1])
