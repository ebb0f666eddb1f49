"""Token files in canonical, length-limited Huffman code.

The code is made from the global counts of the ids, no code longer than ``LIMIT``
bits (package-merge), and canonical: the lengths alone say the codes.  A token file
is a folder with two tables:

- ``lengths``: ``id, bits``, at most one row per id of the vocabulary;
- ``blocks``: in ascending order of documents, rows of shard, block, first (ids of
  the shard before the block), doc_ids, doc_lens, checkpoints (bit offset of each
  ``STEP``-th id) and payload.  A block holds whole documents and decodes alone.

Decoding goes through a table over the next ``LIMIT`` bits.  All stretches between
checkpoints of a block are decoded side by side, one id of each at a time.

Defined cases: null text counts as empty; an empty document is its end id; null ids
come first; repeated ids stay in the order they were tokenized; an empty table makes
a file without blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strandloom.llm.runtime import Scratch, grouped, text_of, workers, written
from strandloom.llm.tokens import binary, encoder, ended

LIMIT = 20
STEP = 128
BLOCK_IDS = 1 << 17
SHARD_IDS = 1 << 22
#: How ids are held between tokenizing and coding: vocabularies of up to 65,536 ids.
KIND = "<u2"
#: Pieces that a worker knows.
CACHE = 500_000
#: Bytes of texts tokenized together, if there is more than one.
GROUP = 8 << 20


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits per symbol by package-merge, 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    packages, kinds = np.empty(0), []
    for _ in range(limit):
        weights = np.concatenate((leaves, packages))
        rank = np.argsort(weights, kind="stable")
        kinds.append(rank < n)
        weights = weights[rank]
        even = len(weights) // 2 * 2
        packages = weights[:even:2] + weights[1:even:2]
    take, bits = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(kinds):
        chosen = int(is_leaf[:take].sum())
        bits[:chosen] += 1
        take = 2 * (take - chosen)
    out[order] = bits
    return out


def canonical(bits: np.ndarray) -> np.ndarray:
    """Codes by (length, id), each one more than the last, shifted as lengths grow."""
    codes = np.zeros(len(bits), np.uint64)
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    steps = np.left_shift(np.uint64(1), (int(bits.max(initial=0)) - bits[order]).astype(np.uint64))
    starts = np.cumsum(steps) - steps
    codes[order] = starts >> (int(bits.max(initial=0)) - bits[order]).astype(np.uint64)
    return codes


def packed(ids: np.ndarray, bits: np.ndarray, codes: np.ndarray, step: int = STEP) -> tuple[bytes, np.ndarray]:
    """The bit string of ``ids``, first bit highest, and the offset of each step-th id."""
    size = bits[ids]
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros(total // 32 + 2, np.uint64)
    word, shift = starts >> 5, (starts & 31).astype(np.uint64)
    value = codes[ids] << (np.uint64(64) - shift - size.astype(np.uint64))  # within two words of 32 bits
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    if len(firsts):
        gathered = np.bitwise_or.reduceat(value, firsts)
        at = word[firsts]
        words[at] |= gathered >> np.uint64(32)
        words[at + 1] |= gathered & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").tobytes()[: (total + 7) // 8], starts[::step]


def decode_table(bits: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Id and length for each value of the next ``limit`` bits."""
    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    reach = np.left_shift(1, limit - bits[order])
    ids = np.zeros(1 << limit, np.uint32)
    size = np.ones(1 << limit, np.int64)
    ids[: reach.sum()] = np.repeat(order, reach)
    size[: reach.sum()] = np.repeat(bits[order], reach)
    return ids, size


def unpacked(payload: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray], limit: int = LIMIT, step: int = STEP) -> np.ndarray:
    """The ``n`` ids of a block."""
    ids, size = table
    raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint64)
    window = sum(raw[k : len(raw) - 3 + k] << np.uint64(24 - 8 * k) for k in range(4))  # 32 bits from each byte
    at = np.array(checkpoints, np.int64)
    out = np.zeros((step, len(at)), np.uint32)
    top = np.int64(len(window) - 1)
    for k in range(step):
        live = len(at) if k < (n - 1) % step + 1 else len(at) - 1  # the last stretch may be shorter
        here = at[:live]
        seen = (window[np.minimum(here >> 3, top)] >> (32 - limit - (here & 7)).astype(np.uint64)) & np.uint64((1 << limit) - 1)
        seen = seen.astype(np.int64)
        out[k, :live] = ids[seen]
        at[:live] += size[seen]
    return out.T.reshape(-1)[:n] if n else np.empty(0, np.uint32)


def tokens(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = 0, special: bool = True) -> DataFrame:
    """id_col, row, n, ids (end id last) per document, as numbers of KIND; ids above them are an error."""
    workers(df.sparkSession)
    kind = df.schema[id_col].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("row", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, "spaced", KIND, special, CACHE)
        for batch in grouped(batches, GROUP):
            ids, ends = ended(*encode(batch.column(2)), end)
            starts = np.append(0, ends)[:-1]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(schema[0].type), batch.column(1), pa.array(ends - starts), binary(ids, starts, ends)], schema=schema)

    texts = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), text_of(text_col).alias("text"))
    return texts.mapInArrow(made, f"id {kind.simpleString()}, row long, n long, ids binary").withColumnRenamed("id", id_col)


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        column = batch.column(0)
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]  # one buffer holds all of a batch
        raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(column) else np.zeros(0, np.uint8)
        total += np.bincount(raw.view(KIND), minlength=1 << 16)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["id", "n"])


def write(made: DataFrame, path: str, id_col: str = "doc_id", limit: int = LIMIT) -> None:
    """Writes saved ``tokens`` as a token file at ``path``."""
    spark = made.sparkSession
    sums = made.select("ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    counts = np.zeros(max((r.id for r in sums), default=-1) + 1, np.int64)
    for r in sums:
        counts[r.id] = r.n
    bits = code_lengths(counts, limit)
    codes = canonical(bits)
    written(spark.createDataFrame([(int(i), int(bits[i])) for i in np.flatnonzero(bits)], "id long, bits int").coalesce(1), f"{path}/lengths")

    kind = made.schema[id_col].dataType
    schema = pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(to_arrow_type(kind))),
        ("doc_lens", pa.list_(pa.int64())), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary()),
    ])

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        docs, parts, held = [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal block, first, docs, parts, held
            ids = np.concatenate(parts)
            payload, marks = packed(ids, bits, codes)
            row = [shard, block, first, docs, [len(x) for x in parts], marks, payload]
            block, first = block + 1, first + len(ids)
            docs, parts, held = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs.append(doc)
                parts.append(np.frombuffer(ids.as_buffer(), KIND))
                held += len(parts[-1])
                if held >= BLOCK_IDS:
                    yield closed()
        if docs:
            yield closed()

    shards = max(1, -(-int(counts.sum()) // SHARD_IDS))
    ordered = made.repartitionByRange(shards, id_col, "row").sortWithinPartitions(id_col, "row").select(id_col, "ids")
    ddl = f"shard int, block int, first long, doc_ids array<{kind.simpleString()}>, doc_lens array<long>, checkpoints array<long>, payload binary"
    written(ordered.mapInArrow(blocks, ddl), f"{path}/blocks")


def read(spark: SparkSession, path: str, id_col: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """id_col, start (ids of all documents before), n, ids per document of a token file."""
    workers(spark)
    stored = spark.read.parquet(f"{path}/blocks")
    lengths = spark.read.parquet(f"{path}/lengths").collect()  # at most the vocabulary
    bits = np.zeros(max((r.id for r in lengths), default=0) + 1, np.int64)
    for r in lengths:
        bits[r.id] = r.bits
    sizes = F.aggregate("doc_lens", F.lit(0).cast("long"), lambda a, x: a + x)
    ends = stored.select("shard", (F.col("first") + sizes).alias("end")).groupBy("shard").agg(F.max("end").alias("end")).collect()  # a row per shard
    base, so_far = {}, 0
    for r in sorted(ends):
        base[r.shard], so_far = so_far, so_far + r.end
    kind = stored.schema["doc_ids"].dataType.elementType
    schema = pa.schema([("id", to_arrow_type(kind)), ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(bits, limit)
        for batch in batches:
            for shard, first, docs, lens, marks, payload in zip(*(batch.column(i) for i in range(6)), strict=True):
                lens = np.array(lens.values, np.int64)
                ids = unpacked(payload.as_py(), np.array(marks.values, np.int64), int(lens.sum()), table, limit).astype("<u4")
                ends = np.cumsum(lens)
                starts = ends - lens
                begin = base[shard.as_py()] + first.as_py()
                yield pa.RecordBatch.from_arrays([docs.values.cast(schema[0].type), pa.array(begin + starts, pa.int64()), pa.array(lens, pa.int64()), binary(ids, starts, ends)], schema=schema)

    rows = stored.select("shard", "first", "doc_ids", "doc_lens", "checkpoints", "payload")
    return rows.mapInArrow(decoded, f"id {kind.simpleString()}, start long, n long, ids binary").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = 0, special: bool = True) -> DataFrame:
    """Tokenizes ``df``, writes the token file to the shared folder and reads it back."""
    scratch = Scratch(df.sparkSession, "tokens")
    made = scratch.save(tokens(df, tokenizer, id_col, text_col, end, special), "made")
    write(made, f"{scratch.root}/file", id_col)
    scratch.drop("made")
    return read(df.sparkSession, f"{scratch.root}/file", id_col)
