"""Quality classifier: a factorisation machine.

Features of a text are its words, hashed, weighted by 1 + log count and scaled to
length one; statistics of its structure (shares of character classes, lengths,
repetition), each put into one of ``BINS`` quantile bins; and its stated number of
characters as metadata, binned by size and by whether it agrees with the text.
Interactions of all pairs have rank ``RANK`` and are summed in linear time, as half
of (sum of v x) squared less the sum of (v x) squared.

The model is fitted in numpy on ``ROWS`` labelled rows at most, drawn by a hash.
Labels, language, source and id aren't features.

Defined cases: null text counts as empty, and an empty text has no words but its
structure, so it has a score; a null number of characters has a bin of its own;
repeated rows have equal scores; an empty table gives an empty result; with no
labelled rows every score is 0.5.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strandloom.llm.labelled import sample
from strandloom.llm.runtime import begun, filtered, kept, text_of, trimmed, workers

ROWS = 6000
WORDS = 1 << 16
RANK = 8
BINS = 16
EPOCHS = 6
CUT = 0.7
CACHE = 100_000
#: How buckets, weights and statistics of a drawn row are sent to the driver.
PARTS = (np.int32, np.float32, np.float64)

_UPPER, _LOWER, _DIGIT, _SPACE = slice(65, 91), slice(97, 123), slice(48, 58), [9, 10, 11, 12, 13, 32]


class _Buckets(dict):
    """Word to its bucket; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORDS
        return found


_BUCKETS = _Buckets()
kept("quality", _BUCKETS.clear)


def structure(text: str, stated: int | None, counts: Counter) -> list[float]:
    """Statistics of the whole text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    seen = np.bincount(raw, minlength=256)
    size, words, distinct = max(1, len(raw)), max(1, sum(counts.values())), max(1, len(counts))
    upper, lower, digit, space = seen[_UPPER].sum(), seen[_LOWER].sum(), seen[_DIGIT].sum(), seen[_SPACE].sum()
    marks = seen[33:127].sum() - upper - lower - digit
    plain = seen[44] + seen[46]
    lines = text.split("\n")
    most = counts.most_common(1)[0][1] if counts else 0
    return [
        np.log1p(len(raw)), np.log1p(words), (size - space) / words, upper / size, digit / size, (marks - plain) / size, plain / words,
        seen[128:].sum() / size, distinct / words, most / words, 1 - len(set(lines)) / len(lines), np.log1p(len(raw) / len(lines)),
        max(map(len, counts), default=0), seen[33:44].max() / size, seen[[124, 60, 62, 123, 125, 47, 92]].sum() / size,
        -1.0 if stated is None else np.log1p(max(0, stated)), -1.0 if stated is None else float(abs(stated - len(text)) > 2),
    ]


def features(text: str, stated: int | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Buckets of words, their weights, statistics."""
    counts = Counter(text.lower().split())
    buckets = np.fromiter(map(_BUCKETS.__getitem__, counts), np.int64, len(counts))
    weights = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    if len(weights):
        weights /= np.sqrt((weights * weights).sum())
    return buckets, weights, structure(text, stated, counts)


@dataclass
class Machine:
    edges: np.ndarray  # BINS - 1 quantiles of each statistic
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def sparse(self, rows: list[tuple[np.ndarray, np.ndarray, list[float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of all rows, their values, and where each row begins."""
        stats = np.array([r[2] for r in rows])
        bins = np.stack([np.searchsorted(e, stats[:, k], side="right") for k, e in enumerate(self.edges)], 1)
        bins += WORDS + BINS * np.arange(len(self.edges))
        index = np.concatenate([x for r, b in zip(rows, bins, strict=True) for x in (r[0], b)])
        value = np.concatenate([x for r in rows for x in (r[1], np.full(len(self.edges), 0.3))])
        starts = np.cumsum([0] + [len(r[0]) + len(self.edges) for r in rows[:-1]])
        return index, value, starts

    def logits(self, rows: list) -> np.ndarray:
        index, value, starts = self.sparse(rows)
        return self._forward(index, value, starts)[0]

    def _forward(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vx = self.factors[index] * value[:, None]
        total = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * ((total * total).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + pairs, total, vx


def fit(rows: list[tuple], y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Machine:
    """Adagrad on the logistic loss, in small batches."""
    rng = np.random.default_rng(seed)
    stats = np.array([r[2] for r in rows])
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    size = WORDS + BINS * len(edges)
    model = Machine(edges, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros(size), rng.normal(0, 0.05, (size, RANK)))
    seen_w, seen_v, seen_b = np.full(size, 1e-2), np.full((size, RANK), 1e-2), 1e-2
    rounds = max(epochs, min(60, 60_000 // max(1, len(rows))))
    for _ in range(rounds):
        order = rng.permutation(len(rows))
        for k in range(0, len(rows), 64):
            part = order[k : k + 64]
            index, value, starts = model.sparse([rows[i] for i in part])
            logit, total, vx = model._forward(index, value, starts)
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]
            spread = np.repeat(error / len(part), np.diff(np.append(starts, len(index))))
            rows_of = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(index))))
            unique, back = np.unique(index, return_inverse=True)
            gw = np.bincount(back, spread * value) + 1e-5 * model.linear[unique]
            each = (spread * value)[:, None] * (total[rows_of] - vx)
            gv = np.stack([np.bincount(back, each[:, f]) for f in range(RANK)], 1) + 1e-5 * model.factors[unique]
            seen_w[unique] += gw * gw
            seen_v[unique] += gv * gv
            model.linear[unique] -= 0.2 * gw / np.sqrt(seen_w[unique])
            model.factors[unique] -= 0.05 * gv / np.sqrt(seen_v[unique])
            gb = float(error.mean())
            seen_b += gb * gb
            model.bias -= 0.1 * gb / np.sqrt(seen_b)
    model.linear, model.factors = model.linear.astype(np.float32), model.factors.astype(np.float32)
    return model


def stated_of(docs: DataFrame) -> Column:
    return F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS) -> Machine | None:
    """A model of ``labels.quality`` from at most ``rows`` usable labelled rows, in the proportion of the classes."""
    workers(docs.sparkSession)
    shares = {r.y: r.n for r in labels.where(usable & F.col("quality").isNotNull()).groupBy(F.col("quality").cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}  # a row per class
    whole = sum(shares.values())
    if len(shares) < 2:
        return None
    most = {y: max(1, rows * n // whole) for y, n in shares.items()}
    drawn = sample(docs, labels, "quality", usable, most, id_col, text_col, {"stated": stated_of(docs)})

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun("quality")
        for batch in batches:
            found = [features(t, n) for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            columns = [pa.array([np.asarray(f[k], t).tobytes() for f in found], pa.binary()) for k, t in enumerate(PARTS)]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), *columns], ["id", "y", "buckets", "weights", "stats"])

    picked = drawn.select("text", "stated", F.xxhash64(id_col).alias("id"), "y").mapInArrow(made, "id long, y int, buckets binary, weights binary, stats binary")
    got = picked.toArrow().sort_by("id")  # at most ``rows`` rows, a few bytes for each distinct word
    y = got["y"].to_numpy().astype(np.float64)
    if len(set(y.tolist())) < 2:
        return None
    columns = [[np.frombuffer(x.as_buffer(), t) for x in got[name]] for name, t in zip(("buckets", "weights", "stats"), PARTS, strict=True)]
    model = fit(list(zip(*columns, strict=True)), y)
    del columns, got
    trimmed()
    return model


def score(docs: DataFrame, model: Machine | None, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """id_col, score, predicted per row of ``docs``."""
    spark = docs.sparkSession
    workers(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun("quality")
        model = shared.value
        for batch in batches:
            found = np.full(batch.num_rows, 0.5)
            if model is not None:
                stated = batch.column(2).to_pylist()
                for k in range(0, batch.num_rows, 64):
                    texts = batch.column(1).slice(k, 64).to_pylist()
                    logit = model.logits([features(t, n) for t, n in zip(texts, stated[k : k + 64], strict=True)])
                    found[k : k + 64] = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(to_arrow_type(kind)), pa.array(found)], ["id", "score"])

    out = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), stated_of(docs).alias("stated")).mapInArrow(scored, f"id {kind.simpleString()}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def drop_low_quality(df: DataFrame, model: Machine | None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """Rows of ``df`` that score at least ``cut``, all of them without a model; all columns stay."""
    workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def keep(batch: pa.RecordBatch) -> list[bool]:
        begun("quality")
        model, out = shared.value, []
        if model is None:
            return [True] * batch.num_rows
        texts = batch.column(batch.schema.get_field_index(text_col))
        stated = batch.column(batch.schema.get_field_index("n_chars")).to_pylist() if "n_chars" in batch.schema.names else [None] * batch.num_rows
        for k in range(0, batch.num_rows, 64):
            found = model.logits([features(t or "", n) for t, n in zip(texts.slice(k, 64).to_pylist(), stated[k : k + 64], strict=True)])
            out += (1 / (1 + np.exp(-np.clip(found.astype(np.float64), -30, 30))) >= cut).tolist()
        return out

    return filtered(df, keep)
