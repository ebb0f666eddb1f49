"""Small files in any store that Spark writes to, and text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    store, found = _at(spark, path)
    return store.exists(found)


def fingerprint(spark: SparkSession, path: str) -> list:
    """Path, bytes and time of change, by which a changed file is noticed; without the latter two if it isn't there."""
    store, found = _at(spark, path)
    if not store.exists(found):
        return [path]
    status = store.getFileStatus(found)
    return [path, status.getLen(), status.getModificationTime()]


def remove(spark: SparkSession, path: str) -> None:
    store, found = _at(spark, path)
    store.delete(found, True)


def write(spark: SparkSession, path: str, content: bytes | str) -> None:
    """A whole file or none: written beside its place, then moved there."""
    store, found = _at(spark, path)
    _, beside = _at(spark, f"{path}.part")
    out = store.create(beside, True)
    try:
        out.write(bytearray(content.encode() if isinstance(content, str) else content))
    finally:
        out.close()
    store.delete(found, False)
    if not store.rename(beside, found):
        raise OSError(f"can't write {path}")


def read(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def write_tsv(df: DataFrame, path: str) -> None:
    """Gzip text with a header; structs and arrays have no place in it, truth is true or false, null is empty."""
    df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).write.mode("overwrite").csv(path, sep="\t", header=True, compression="gzip", emptyValue="", nullValue="")


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A text table of the given columns; another header is an error."""
    return spark.read.csv(path, schema=schema, sep="\t", header=True, enforceSchema=False, mode="FAILFAST")
