"""Best-fit packing of documents into sequences by large-item matching.

Each document's ids, an end id last, are cut into pieces of the capacity at most;
only longer ones are cut.  Pieces above a third of the capacity are large: a
sequence holds two of them at most.  From the largest down, each is matched with the
largest other one that still fits beside it.  The small pieces, from the largest
down, go into the fullest sequence that has room, else into a new one.

Pieces are dealt to shards by a hash, about ``SHARD`` to each; a shard is packed in
one task from its lengths alone, so the work grows with the number of shards, and
what a shard loses is its last sequence.

Defined cases: null text counts as empty, an empty document is its end id; null or
repeated ids are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strandloom.llm.runtime import Scratch, text_of, workers
from strandloom.llm.tokens import binary, encoder, ended

CAPACITY = 4096
END = 1
SHARD = 1 << 15


def pieces(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, special: bool = True
) -> DataFrame:
    """id_col, row, piece, start, length, ids (little-endian unsigned 32-bit) per piece.

    ``row`` tells apart rows that share an id; save the result before using it twice.
    """
    workers(df.sparkSession)
    kind = df.schema[id_col].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, "words", special=special)
        for batch in batches:
            ids, ends = ended(*encode(batch.column(2)), end)
            begins = np.append(0, ends)[:-1]
            many = -(-(ends - begins) // capacity)
            doc = np.repeat(np.arange(len(ends)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            starts = begins[doc] + piece * capacity
            stops = np.append(starts[1:], ends[-1:])
            columns = [batch.column(1).take(pa.array(doc)).cast(schema[0].type), batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(piece * capacity), pa.array(stops - starts)]
            yield pa.RecordBatch.from_arrays([*columns, binary(ids, starts, stops)], schema=schema)

    texts = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    made = texts.mapInArrow(cut, f"id {kind.simpleString()}, row long, piece int, start long, length long, ids binary")
    return made.withColumnRenamed("id", id_col)


def matched(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Sequences as lists of positions in ``lengths``."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    large = [i for i in order if 3 * lengths[i] > capacity]
    bins: list[list[int]] = []
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    held = 0  # bit r is set while rooms[r] has sequences

    # lengths of unmatched large pieces, a stack of positions for each
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0
    for i in reversed(large):
        waiting[lengths[i]].append(i)
        some |= 1 << lengths[i]

    def taken(length: int) -> int:
        nonlocal some
        i = waiting[length].pop()
        if not waiting[length]:
            some &= ~(1 << length)
        return i

    def put(b: int, room: int) -> None:
        nonlocal held
        rooms[room].append(b)
        held |= 1 << room

    while some:
        i = taken(some.bit_length() - 1)
        room = capacity - lengths[i]
        beside = (some & ((1 << (room + 1)) - 1)).bit_length() - 1
        bins.append([i] if beside < 0 else [i, taken(beside)])
        put(len(bins) - 1, room - max(beside, 0))
    for i in order[len(large) :]:
        fits = held >> lengths[i]
        if fits:
            room = lengths[i] + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                held &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        put(b, room - lengths[i])
    return bins


def placed(cut: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """row, piece, sequence_id, offset for saved ``pieces``."""
    shards = max(1, -(-cut.count() // shard))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        lengths = pdf["length"].to_numpy()
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for b, members in enumerate(matched(lengths.tolist(), capacity)):
            sequence[members] = b
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        sequence += int(pdf["shard"].iloc[0]) << 32
        return pd.DataFrame({"row": pdf["row"], "piece": pdf["piece"], "sequence_id": sequence, "offset": offset})

    key = F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).alias("shard")
    return cut.select("row", "piece", "length", key).groupBy("shard").applyInPandas(pack, "row long, piece int, sequence_id long, offset long")


def pack(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    shard: int = SHARD,
    derived: dict[str, Column] | None = None,
    special: bool = True,
    stored: bool = False,
) -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids, sequence_id, offset.

    With ``derived``, columns computed from a piece's ids take the place of the ids,
    so that the ids themselves needn't be shuffled.  ``stored``: ``df`` is read straight
    from files, and the pieces are held, without their ids if there are derived columns.
    """
    scratch = Scratch(df.sparkSession, "packing")
    cut = pieces(df, tokenizer, id_col, text_col, capacity, end, special)
    if stored and derived:
        cut, derived = cut.withColumns(derived).drop("ids"), None
    cut = scratch.hold(cut) if stored else scratch.save(cut, "pieces")
    where = scratch.save(placed(cut, capacity, shard), "placed")
    if derived:
        cut = cut.withColumns(derived).drop("ids")
    return cut.join(where, ["row", "piece"]).drop("row")
