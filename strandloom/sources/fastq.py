"""Paired FASTQ files, plain or compressed, from any store.

Gzip can't be split, so both files of a sample are read side by side, record by record,
in one task of its own and without a shuffle; the same way leading pairs are read, and
reading stops after the last one asked for.  Whole plain files, which can be split, are
read in blocks by all tasks instead, and their records meet by number.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import islice, zip_longest

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.plans.config import ConfigError
from strandloom.plans.tables import importable, saved

#: Pairs that a task hands over at once.
STEP = 10_000
PAIR = "sample string, number long, read_id string, r1_seq string, r2_seq string"


def opened(path: str) -> io.TextIOBase:
    """Lines of a file on this machine or in a store, gunzipped by suffix."""
    store, name = fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][\w+.-]*:/", path) else (fs.LocalFileSystem(), path)
    raw = io.BufferedReader(store.open_input_stream(name, compression=None))
    return io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw, newline=None)


def parsed(lines: Iterable[str], path: str) -> Iterator[tuple[str, str]]:
    """read_id, seq of each record; one that isn't FASTQ raises an error."""
    lines = (x.rstrip() for x in lines)
    for number, head in enumerate(lines):
        seq, plus, quality = (next(lines, None) for _ in range(3))
        if quality is None:
            raise ValueError(f"{path} ends within a record")
        if not (head.startswith("@") and plus.startswith("+") and len(seq) == len(quality)):
            raise ValueError(f"{path}: record {number} isn't FASTQ")
        name = (head[1:].split() or [""])[0]
        yield name[:-2] if name.endswith(("/1", "/2")) else name, seq.upper()


def lockstep(spark: SparkSession, files: dict[str, tuple[str, str]], most: int | None = None) -> DataFrame:
    """sample, number, read_id, r1_seq, r2_seq: a task for each sample, which stops after ``most`` pairs."""
    importable(spark)
    listed = sorted(files.items())

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sample, (r1, r2) in (listed[k] for k in batch.column(0).to_pylist()):
                with opened(r1) as left, opened(r2) as right:
                    both = islice(enumerate(zip_longest(parsed(left, r1), parsed(right, r2))), most)
                    while rows := list(islice(both, STEP)):
                        for number, (x, y) in rows:
                            if x is None or y is None or x[0] != y[0]:
                                raise ValueError(f"{sample}: pair {number} doesn't match")
                        columns = [[sample] * len(rows), [n for n, _ in rows], [x[0] for _, (x, _) in rows], [x[1] for _, (x, _) in rows], [y[1] for _, (_, y) in rows]]
                        kinds = (pa.string(), pa.int64(), *[pa.string()] * 3)
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [x.split()[0] for x in PAIR.split(", ")])

    return spark.range(0, len(listed), 1, max(1, len(listed))).mapInArrow(read, PAIR)


def records(spark: SparkSession, path: str) -> DataFrame:
    """number, read_id, seq of one file.

    Lines are numbered within the file's blocks, which are read in parallel; a
    block's first number comes from the line counts of the blocks before it, one
    small row each.  Records that don't have four lines, ``@``, ``+`` and
    qualities as long as the sequence raise an error.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.rtrim("value").alias("value"))
    lines = saved(lines)
    blocks = sorted(lines.groupBy("block").agg(F.count("*").alias("n"), F.min("id").alias("first")).collect())
    if sum(b.n for b in blocks) % 4:
        raise ConfigError(f"{path} ends within a record")
    starts, so_far = [], 0
    for b in blocks:
        starts.append((b.block, so_far - b.first))
        so_far += b.n
    if not starts:
        return spark.createDataFrame([], "number long, read_id string, seq string")
    shift = F.broadcast(spark.createDataFrame(starts, "block long, shift long"))
    placed = lines.join(shift, "block").withColumn("line", F.col("id") + F.col("shift"))
    part = lambda k: F.max(F.when(F.col("line") % 4 == k, F.col("value")))
    whole = placed.groupBy(F.floor(F.col("line") / 4).alias("number")).agg(*[part(k).alias(c) for k, c in enumerate(("head", "seq", "plus", "qual"))])
    bad = ~F.col("head").startswith("@") | ~F.col("plus").startswith("+") | (F.length("seq") != F.length("qual"))
    name = F.regexp_replace(F.regexp_extract("head", r"^@\s*(\S*)", 1), "/[12]$", "")
    told = F.concat(F.lit(f"{path}: record "), F.col("number").cast("string"), F.lit(" isn't FASTQ"))
    return whole.select("number", F.when(bad, F.raise_error(told)).otherwise(name).alias("read_id"), F.upper("seq").alias("seq"))


def joined(spark: SparkSession, sample: str, r1: str, r2: str) -> DataFrame:
    """What ``lockstep`` gives for one sample, from blocks of both files."""
    left = records(spark, r1).withColumnRenamed("seq", "r1_seq")
    right = records(spark, r2).select("number", F.col("read_id").alias("other"), F.col("seq").alias("r2_seq"))
    both = left.join(right, "number", "full")
    told = F.concat(F.lit(f"{sample}: pair "), F.col("number").cast("string"), F.lit(" doesn't match"))
    same = F.coalesce(F.col("read_id") == F.col("other"), F.lit(False))
    return both.select(F.lit(sample).alias("sample"), "number", F.when(same, F.col("read_id")).otherwise(F.raise_error(told)).alias("read_id"), "r1_seq", "r2_seq")


def samples(spark: SparkSession, files: dict[str, tuple[str, str]], most: int | None = None) -> DataFrame:
    """sample, number, read_id, r1_seq, r2_seq of all samples; with ``most``, the leading pairs of each.

    Records are those at the same place of both files; different counts or names
    raise an error.
    """
    plain = {k: v for k, v in files.items() if most is None and not any(x.endswith(".gz") for x in v)}
    frames = [joined(spark, name, *both) for name, both in plain.items()]
    if rest := {k: v for k, v in files.items() if k not in plain}:
        frames.append(lockstep(spark, rest, most))
    return reduce(DataFrame.unionByName, frames)


def pairs(spark: SparkSession, sample: str, r1: str, r2: str, most: int | None = None) -> DataFrame:
    """One sample's pairs."""
    return samples(spark, {sample: (r1, r2)}, most)


def whitelist(spark: SparkSession, path: str) -> DataFrame:
    """name, known from lines of a sequence, or of a name and a sequence; ``#`` begins a comment."""
    text = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' and not startswith(v, '#')")
    parts = F.split("v", "\t")
    found = saved(text.select(F.element_at(parts, 1).alias("name"), F.upper(F.trim(F.element_at(parts, -1))).alias("known")))
    if found.groupBy("known").count().where("count > 1").head(1):
        raise ConfigError(f"{path} repeats a sequence")
    if not found.head(1):
        raise ConfigError(f"{path} is empty")
    return found


def annotation(spark: SparkSession, path: str, columns: tuple[str, str, str], allow_duplicate_names: bool = False) -> DataFrame:
    """sequence, name of features from a tab-separated table.

    A first line that has all of ``columns`` (id, sequence, name) is a header.  Without
    one, fields are id, sequence and name, or id and sequence, which is its own name.
    """
    lines = spark.read.text(path).select(F.rtrim("value").alias("v")).where("v <> ''")
    head = (lines.head() or [""])[0]
    first = [x.strip() for x in head.split("\t")]
    titled = set(columns) <= set(first)
    if not titled and len(first) < 2:
        raise ConfigError(f"{path} is empty, or its lines have no sequence")
    at, named = (first.index(columns[1]), first.index(columns[2])) if titled else (1, 2)
    cells = F.split("v", "\t")
    sequence = F.upper(F.trim(F.get(cells, F.lit(at))))
    name = F.trim(F.get(cells, F.lit(named)))
    name = F.coalesce(name, F.lit("") if titled else sequence)
    rows = lines.where(F.col("v") != head) if titled else lines
    found = saved(rows.select(sequence.alias("sequence"), name.alias("name")))
    for column in ("sequence",) if allow_duplicate_names else ("sequence", "name"):
        if again := found.groupBy(column).count().where("count > 1").head(1):
            raise ConfigError(f"{path} repeats {again[0][0]}")
    return found
