"""Reads made from the table ``events`` by arithmetic, for queries and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.plans.config import Correction, Plan, Segment

FEATURES = {"click": "AACCGG", "view": "TTGGCC", "purchase": "GATACA", "error": "CTCTAG", "signup": "TGCAAT"}
LINKER = "AGGTC"

PLAN = Plan(
    segments=(
        Segment("CELL", "barcode1", "R1", 8, start=0, right=LINKER),
        Segment("FB", "barcode2", "R2", 6, start=6, correction=Correction(shift=0)),
        Segment("UMI", "umi", "R2", 6, start=0, correction=Correction(enabled=False)),
    ),
    ratios=(0.1, 0.25, 0.5, 0.75, 0.9),
    repeats=2,
)


def base4(number: Column, letters: int) -> Column:
    """A number's lowest digits in base 4, as letters."""
    digit = lambda k: F.substr(F.lit("ACGT"), F.floor(number / 4**k).cast("bigint") % 4 + 1, F.lit(1))
    return F.concat(*[digit(k) for k in range(letters)])


def barcode(user: Column) -> Column:
    return base4(user * 37, 8)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, read_id, r1_seq, r2_seq, with errors at fixed distances in event_id."""
    events, e = spark.read.parquet(f"{sf_dir}/events.parquet"), F.col("event_id")
    cell, umi = barcode(F.col("user_id")), base4((e * 7919) % 24 * 3, 6)
    feature = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in FEATURES.items()])
    turned = lambda c: F.translate(c, "ACGT", "CGTA")
    at = (e % 8 + 1).cast("int")
    cell = F.when(e % 11 == 0, F.overlay(cell, turned(F.substr(cell, at, F.lit(1))), at, F.lit(1))).otherwise(cell)
    feature = F.when(e % 23 == 0, F.concat(F.substring(feature, 1, 5), turned(F.substring(feature, 6, 1)))).otherwise(feature)
    umi = F.when(e % 19 == 0, F.concat(F.lit("N"), F.substring(umi, 2, 5))).otherwise(umi)
    linker = F.when(e % 17 == 0, "ANNTC").otherwise(LINKER)
    r1 = F.concat(F.when(e % 13 == 0, "N").otherwise(""), cell, linker)
    return events.select(
        F.concat(F.lit("S"), e % 2).alias("sample"), F.concat(F.lit("r"), e).alias("read_id"),
        F.when(e % 29 == 0, F.substring(r1, 1, 6)).otherwise(r1).alias("r1_seq"), F.concat(umi, feature).alias("r2_seq"),
    )


def whitelists(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cells = events.select("user_id").distinct().select(barcode(F.col("user_id")).alias("known"))
    return {"CELL": cells, "FB": spark.createDataFrame([(x,) for x in FEATURES.values()], "known string")}


def annotation(spark: SparkSession) -> DataFrame:
    """Names of all features but one, so that something is missing."""
    return spark.createDataFrame([(v, k.upper()) for k, v in FEATURES.items() if k != "signup"], "sequence string, name string")
