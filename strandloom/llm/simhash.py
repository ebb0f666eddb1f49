"""SimHash near-duplicates by multi-index hashing.

Fingerprints of 64 bits link at two differing bits at most.  Each is cut into two
segments of 32 bits; of two linked fingerprints at least one segment differs by
one bit at most.  So every distinct fingerprint is stored once under each segment,
and looks up the Hamming ball of radius one around each of its own segments; full
distances are verified on what is fetched.  A pair at distance one in a segment is
fetched from one side only: that which has the bit set.

Segments under which more than ``crowded`` distinct fingerprints are stored are
indexed once more: the other half differs by two bits at most, so of its three
parts one agrees.  No bucket or partner is capped.

Defined cases: null text counts as empty; texts without words have fingerprint
zero, which links like any other; a null id is larger than any other; rows that
repeat an id have a row each in the result, and of equal ids the first written is
the first of its component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.graph import components
from strandloom.llm.runtime import Scratch, begun, merged, numbered, sized, text_of, without, workers

SEED = 42
SHINGLE = 3
DISTANCE = 2
CROWDED = 512
#: Shingles hashed before their bits are summed: bounds the memory of long texts.
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit is one where over half of the shingles' hashes have it."""
    words = text.lower().split()  # on bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(starts), BLOCK):
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[k : k + BLOCK].tolist(), ends[k : k + BLOCK].tolist(), strict=True)]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
        total += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts)).view(">i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begun("simhash")
    for batch in batches:
        found = [fingerprint(x.as_buffer().to_pybytes()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["rid", "id", "fp"])


def links(distinct: DataFrame, scratch: Scratch, crowded: int = CROWDED) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column fp) within the distance."""
    halves = F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    parts = distinct.select("fp", F.posexplode(halves).alias("seg", "value"))
    key = (F.col("seg").cast("long") * (1 << 32) + F.col("value")).alias("key")
    stored = scratch.save(parts.select("fp", "seg", key), "stored")
    ball = F.expr(
        "concat(array(value), transform(filter(sequence(0, 31), i -> getbit(value, i) = 1), i -> value ^ shiftleft(1L, i)))"
    )
    probes = parts.select("fp", "seg", F.explode(ball).alias("value")).select("fp", "seg", key)

    def verified(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        met = left.select(F.col("fp").alias("x"), *on).join(merged(right.select(F.col("fp").alias("y"), *on)), on)
        near = met.where((F.col("x") != F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= DISTANCE))
        return near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    hot = scratch.save(stored.groupBy("key").count().where(F.col("count") > crowded).select("key"), "hot")
    if not (n := hot.count()):
        return verified(probes, stored, ["key"]).distinct()
    hot = sized(hot, n)

    def finer(df: DataFrame) -> DataFrame:
        other = F.when(F.col("seg") == 0, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
        thirds = F.array(*(F.shiftrightunsigned(other, s).bitwiseAND(F.lit(m)) for s, m in ((0, 0x7FF), (11, 0x7FF), (22, 0x3FF))))
        return df.join(hot, "key", "left_semi").select("fp", "key", F.posexplode(thirds).alias("part", "sub"))

    plain = verified(probes, stored.join(hot, "key", "left_anti"), ["key"])
    return plain.union(verified(finer(probes), finer(stored), ["key", "part", "sub"])).distinct()


def _marked(rows: DataFrame) -> DataFrame:
    """From (rid, id, text): (rid, id, fp)."""
    workers(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_fingerprints, f"rid long, id {kind}, fp long")


def _labelled(marked: DataFrame, scratch: Scratch, crowded: int) -> DataFrame:
    """From kept (rid, id, fp): for each fp its component's first row and its links, saved."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("lead")
    distinct = scratch.save(marked.groupBy("fp").agg(first), "distinct")
    edges = scratch.save(links(distinct, scratch, crowded), "edges")
    degree = edges.select("a").union(edges.select("b")).groupBy(F.col("a").alias("fp")).agg(F.count("*").alias("links"))
    member = scratch.save(components(edges, scratch).withColumnRenamed("node", "fp"), "member")
    owner = scratch.save(member.join(merged(distinct), "fp").groupBy("component").agg(F.min("lead").alias("owner")), "owner")
    found = scratch.save(member.join(merged(owner), "component").join(merged(degree), "fp", "left").select("fp", "owner", "links"), "found")
    label = distinct.join(merged(found), "fp", "left").select("fp", F.coalesce("owner", "lead").alias("lead"), F.coalesce("links", F.lit(0)).alias("links"))
    return scratch.save(label, "label")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED) -> DataFrame:
    """One row per row of ``df``: id_col, fingerprint (hex), component_id, links.

    ``links`` counts the other distinct fingerprints that the row's own links to.
    """
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    scratch = Scratch(df.sparkSession, "simhash")
    marked = scratch.save(_marked(rows), "marked")
    label = _labelled(marked, scratch, crowded)
    return marked.join(merged(label), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("lead.id").alias("component_id"), "links"
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED, stored: bool = False) -> DataFrame:
    """``df`` with the first row of each component (smallest id); all columns stay.

    ``stored``: ``df`` is read straight from files, so no copy of it is needed.
    """
    scratch = Scratch(df.sparkSession, "simhash")
    rows = numbered(df, scratch, stored)
    marked = scratch.hold(_marked(rows.select("rid", F.col(f"row.{id_col}").alias("id"), text_of(f"row.{text_col}").alias("text"))))
    label = _labelled(marked, scratch, crowded)
    return without(rows, scratch.save(marked.join(merged(label), "fp").where("lead.rid <> rid").select("rid"), "gone"))
