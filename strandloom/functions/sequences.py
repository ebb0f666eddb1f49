"""Expressions over DNA sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def mismatches(text: Column, known: str) -> Column:
    """Positions in which a text of the same length differs from a known one; unrolled."""
    return reduce(lambda a, b: a + b, [(text.substr(i + 1, 1) != F.lit(c)).cast("int") for i, c in enumerate(known)])


def hamming(a: Column, b: Column) -> Column:
    """Differing positions; of unequal lengths, the longer length."""
    differ = F.aggregate(
        F.sequence(F.lit(1), F.length(a)), F.lit(0), lambda n, i: n + (F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))).cast("int")
    )
    return F.when(F.length(a) != F.length(b), F.greatest(F.length(a), F.length(b))).when(F.length(a) == 0, 0).otherwise(differ)


def positions(text: Column, linker: str, most: int) -> Column:
    """All places (from 0) where the linker matches with at most ``most`` mismatches; overlaps count."""
    n = len(linker)
    places = F.sequence(F.lit(0), F.length(text) - n)
    hits = F.filter(places, lambda p: mismatches(F.substr(text, p + 1, F.lit(n)), linker) <= most)
    return F.when(F.length(text) >= n, hits).otherwise(F.array().cast("array<int>"))


def first_match(text: Column, linker: str, most: int) -> Column:
    """Place of the best match: fewest mismatches, then leftmost; null if none."""
    n = len(linker)
    if not most:
        return F.nullif(F.instr(text, linker), F.lit(0)) - 1
    ranked = F.transform(positions(text, linker, most), lambda p: F.struct(mismatches(F.substr(text, p + 1, F.lit(n)), linker).alias("m"), p.alias("p")))
    return F.array_min(ranked)["p"]


def wildcards(text: Column) -> Column:
    """One key per position, that position replaced by a star."""
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.overlay(text, F.lit("*"), i, F.lit(1)))


def starred(text: Column, stars: int) -> Column:
    """Keys with ``stars`` positions replaced: texts of one length share one if and only if they differ in so many at most.

    A text that isn't longer than that has one key, all stars.
    """
    made = F.array(F.struct(text.alias("key"), F.lit(0).alias("at")))
    for left in reversed(range(stars)):
        further = lambda s, left=left: F.transform(
            F.sequence(s["at"] + 1, F.length(text) - left), lambda i: F.struct(F.overlay(s["key"], F.lit("*"), i, F.lit(1)).alias("key"), i.alias("at"))
        )
        made = F.flatten(F.transform(made, further))
    return F.when(F.length(text) > stars, F.transform(made, lambda s: s["key"])).otherwise(F.array(F.repeat(F.lit("*"), F.length(text))))
