"""Exact de-duplication by distributed MSD radix partitioning.

Documents start in one group.  Each level reads the next digit, a block of bytes
of the normalised text, and splits every group by it.  A group that is left with
one member, or whose members have ended, is finished; the rest goes on to the
next block.  Equality is decided by the bytes alone: the SHA-256 is output, never
a key.

A digit is a block and not a single byte, so that a text of n bytes needs about
log(n) levels and not n: blocks start at 64 bytes, and each is three times as long
as all before it, up to 256 KiB.

Defined cases: null text counts as empty; empty texts are equal to each other; a
null id is larger than any other; of rows that share both text and id one stays; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.runtime import Scratch, merged, numbered, sized, text_of, without

FIRST_DIGIT = 64
LONGEST_DIGIT = 1 << 18


def normalised(column: str) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text_of(column), r"[\x20\x09-\x0D]+", " ")


def _bodies(rows: DataFrame, *columns: Column) -> DataFrame:
    """From (rid, id, text): rid, id, the normalised text's size, and ``columns`` of it (body)."""
    body = F.encode(normalised("text"), "UTF-8").alias("body")
    return rows.select("rid", "id", body).select("rid", "id", F.octet_length("body").alias("size"), *columns)


def _head(first_digit: int) -> Column:
    return F.substring("body", 1, first_digit).alias("body")


def _groups(rows: DataFrame, lite: DataFrame, scratch: Scratch, first_digit: int) -> DataFrame:
    """From (rid, id, text), numbered alike at each reading, and their kept heads: (rid, n, lead) of those in groups."""
    offset, width, level = 0, first_digit, 0
    source = lite.withColumn("gid", F.lit(0).cast("long"))
    finished: list[DataFrame] = []
    key = ["gid", "ended", "digit"]
    while True:
        parts = source.select("rid", "id", "gid", (F.col("size") <= offset + width).alias("ended"), F.substring("body", offset + 1, width).alias("digit"))
        first = F.coalesce(F.min_by("rid", "id"), F.min("rid"))  # plain numbers, so that rows are aggregated by hash
        found = parts.groupBy(*key).agg(F.min("id").alias("keep"), first.alias("first"), F.count("*").alias("n")).where("n > 1")
        found = scratch.save(found, f"found-{level}")
        split = parts.drop("id").join(merged(found), key)
        split = scratch.save(split.select("rid", "ended", "n", F.struct(F.col("keep").alias("id"), F.col("first").alias("rid")).alias("lead")), f"split-{level}")
        scratch.drop(f"found-{level}")
        finished.append(split.where("ended").select("rid", "n", "lead"))
        left = split.where("not ended").select("rid", F.col("lead.rid").alias("gid"))
        if not (alive := left.count()):
            break
        if level == 0:  # later levels read the texts of these rows only
            survivors = rows.join(sized(left.select("rid"), alive), "rid", "left_semi")
            survivors = scratch.save(_bodies(survivors, F.col("body")), "survivors")
        source = survivors.join(sized(left, alive), "rid")
        offset, width, level = offset + width, min(3 * (offset + width), LONGEST_DIGIT), level + 1

    groups = finished[0]
    for part in finished[1:]:
        groups = groups.union(part)
    return groups


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", first_digit: int = FIRST_DIGIT) -> DataFrame:
    """One row per row of ``df``: id_col, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(df.sparkSession, "radix")
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = scratch.save(rows, "rows")
    lite = scratch.save(_bodies(rows, F.sha2("body", 256).alias("sha"), _head(first_digit)), "lite")
    groups = _groups(rows, lite, scratch, first_digit)
    return lite.select("rid", "id", "sha").join(merged(groups), "rid", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("lead").isNull(), F.col("id")).otherwise(F.col("lead.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("lead.rid") == F.col("rid"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stored: bool = False) -> DataFrame:
    """``df`` without the later rows of each group of equal texts; all columns stay.

    ``stored``: ``df`` is read straight from files, so no copy of it is needed.
    """
    scratch = Scratch(df.sparkSession, "radix")
    rows = numbered(df, scratch, stored)
    texts = rows.select("rid", F.col(f"row.{id_col}").alias("id"), text_of(f"row.{text_col}").alias("text"))
    groups = _groups(texts, scratch.hold(_bodies(texts, _head(FIRST_DIGIT))), scratch, FIRST_DIGIT)
    return without(rows, scratch.save(groups.where("lead.rid <> rid").select("rid"), "gone"))
