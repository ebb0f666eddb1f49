"""Intermediate tables in the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.sources import files

_OWN: dict[str, str] = {}
#: Rows up to which a counted table may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 500_000


_MADE: list[str] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that were saved within, at its end: what is kept must be written before."""
    before = len(_MADE)
    try:
        yield
    finally:
        for path in _MADE[before:]:
            files.remove(spark, path)
        del _MADE[before:]


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where unset, a temporary folder, in one process only."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="strandloom-")
        atexit.register(shutil.rmtree, _OWN[context.applicationId], ignore_errors=True)
    return f"file://{_OWN[context.applicationId]}"


def importable(spark: SparkSession) -> None:
    """Lets Python workers of this machine, and of others with the same paths, import this package."""
    top, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if top not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (top, env.get("PYTHONPATH", "")) if x)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written and read again: lineage ends here and outlives lost executors."""
    path = f"{folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    _MADE.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A saved table, marked for broadcast if its counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
