"""Shared folder, checkpoint tables and worker set-up of the corpus operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table of one or two numbers a row may be broadcast
#: (under 64 MB); beyond it the same join is a shuffled one.
BROADCAST_ROWS = 1_000_000
#: Measured bytes up to which a table with texts may be broadcast.
BROADCAST_BYTES = 4 << 20

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset and Spark runs in one process, a temporary folder is used;
    on a cluster that is an error, as executors couldn't see such a folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = context.applicationId
    if app not in _OWN:
        own = tempfile.mkdtemp(prefix="strandloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN[app] = f"file://{own}"
        context.setCheckpointDir(_OWN[app])
    return _OWN[app]


_ROOTS: list[str] = []
_HELD: list[DataFrame] = []


def removed(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables of all operators called within, at its end: their results must be written before."""
    before, held = len(_ROOTS), len(_HELD)
    try:
        yield
    finally:
        for df in _HELD[held:]:
            df.unpersist()
        del _HELD[held:]
        for root in _ROOTS[before:]:
            removed(spark, root)
        del _ROOTS[before:]


#: Local files without others of checksums.  Java starts a chmod for each file and folder that
#: it makes, and such a process has the whole memory of the JVM until it runs.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def written(df: DataFrame, path: str) -> None:
    """Writes an intermediate table, in place of one that is there."""
    df.write.mode("overwrite").options(**PLAIN_FILES).parquet(path)


class Scratch:
    """Tables of one operator call, written to the shared folder.

    A written table cuts the lineage and survives lost executors.  ``drop`` frees
    a table early; the rest stays until the ``scope`` around the call ends, because the
    result that the caller holds may still read it.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _ROOTS.append(self.root)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        written(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def hold(self, df: DataFrame) -> DataFrame:
        """``df``, kept on the executors' disks from its first use until the ``scope`` ends.

        No file is made by way of Hadoop, so no process starts (see PLAIN_FILES).  A lost
        part is made again: ``df`` must give the same rows in the same order each time,
        and its plan is part of every plan above, so it should be short.
        """
        _HELD.append(df.persist(StorageLevel.DISK_ONLY))
        return _HELD[-1]

    def drop(self, *names: str) -> None:
        for name in names:
            removed(self.spark, f"{self.root}/{name}")


#: Lets workers give freed memory back at once: they live on from stage to stage.
MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
}


#: What the operators keep in a worker from task to task: how to forget it.
_KEPT: dict[str, Callable[[], None]] = {}
_LAST: list[str] = []


def kept(owner: str, forget: Callable[[], None]) -> None:
    """Declares a cache of this process."""
    _KEPT[owner] = forget


def begun(owner: str) -> None:
    """At the start of a task: forgets what other operators have left in this worker."""
    if _LAST != [owner]:
        _LAST[:] = [owner]
        for other, forget in _KEPT.items():
            if other != owner:
                forget()
        trimmed()


def workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and hold batches of 4 MB.

    Both hold for the caller's session from then on: its workers' environment, and
    the size of Arrow batches.
    """
    top = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if top not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (top, env.get("PYTHONPATH", "")) if x)
    env.update(MEMORY)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else merged(df)


def trimmed() -> None:
    """Gives memory that a fit has freed back to the system, where the C library can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def weighed(df: DataFrame, *columns: str) -> DataFrame:
    """A saved ``df`` marked for broadcast if its rows and the bytes of its wide ``columns`` are within the bound."""
    bytes_of = sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in columns), F.count("*") * 64)
    return F.broadcast(df) if df.agg(bytes_of).first()[0] <= BROADCAST_BYTES else merged(df)


def merged(df: DataFrame) -> DataFrame:
    """``df`` marked for a sort-merge join: for sides that grow with the data and weren't counted.

    Adaptive execution otherwise judges by compressed shuffle bytes, and builds
    hash tables many times larger on the driver.
    """
    return df.hint("merge")


def text_of(column: str) -> Column:
    """The column as text, null counted as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def numbered(df: DataFrame, scratch: Scratch, stored: bool = False) -> DataFrame:
    """``df`` as rid, a number of its own for each row, and row, a struct of its columns.

    It is saved, since another order of rows would give other numbers, unless ``df`` is
    ``stored``: read straight from files, so that each reading numbers it alike.
    """
    columns = [df[f"`{c}`"] for c in df.columns]
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.struct(*columns).alias("row"))
    return rows if stored else scratch.save(rows, "numbered")


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The columns of ``numbered`` rows whose rid isn't in ``dropped`` (saved)."""
    return rows.join(sized(dropped.select("rid"), dropped.count()), "rid", "left_anti").select("row.*")


def filtered(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """Rows of ``df`` that ``keep`` says yes to, batch by batch, whatever else their columns are."""

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), pa.bool_()))

    return df.mapInArrow(kept, df.schema)


def grouped(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches side by side as one, until they hold ``most`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
