"""Toxicity classifier: a convolutional network over hashed word embeddings.

A text's words, lower-cased, are looked up in three tables of embeddings by hashes
of the word and of its first four and six letters: words that meet in one table are
told apart by another, and unseen forms of a known stem are met.  Filters
over one, two and three words run along the whole text; each keeps its largest
value, and a logistic layer joins them.  The first dimension of an embedding starts
as the damped log odds of its bucket among the fitted rows; everything is then
trained in numpy by back-propagation.  For scoring, each table is multiplied with
the filters once, so a word costs three look-ups and a few additions.

At most ``ROWS`` labelled rows of each class are drawn by a hash.  Every fifth of a
class isn't fitted but calibrates the scale of the scores.  Each language's threshold
comes from all usable labelled rows that weren't fitted, drawn or not, whose scores
are counted in bins by Spark.  This holds for any number of rows: none is both fitted
and calibrated on.  Labels, language, source and id are no inputs of the score; a
language's threshold only turns scores into decisions.

Defined cases: null text counts as empty; an empty text scores as one without known
words; rows of an unknown or null language use the common threshold; repeated rows
have equal scores; an empty table gives an empty result; with no labelled rows of
both classes every score is 0; with fewer than five rows of a class the scale stays
as fitted; a language with fewer than five unfitted rows of a class uses the common
threshold.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strandloom.llm.labelled import known, platt, sample
from strandloom.llm.runtime import begun, filtered, kept, sized, text_of, trimmed, workers

ROWS = {1: 2500, 0: 4000}
BUCKETS = 1 << 16
TABLES = 3
DIMS = 4
FILTERS = 6
WIDTHS = (1, 2, 3)
EPOCHS = 4
CUT = 0.5
#: Bins of scores to a unit of the logit, up to 30 on either side.
BINS = 64
CACHE = 100_000
#: Words whose filters are computed at once, in fitting too; bounds the memory of long texts.
BLOCK = 1 << 14

WORD = re.compile(r"[^\W\d_]+")
COLUMNS = FILTERS * sum(WIDTHS)


class _Hashes(dict):
    """Word to its buckets in one number, the first table's lowest; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        forms = (word, word[:4] + "-", word[:6] + "--")
        self[word] = found = sum(zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS * BUCKETS**k for k, x in enumerate(forms))
        return found


_HASHES = _Hashes()
kept("toxicity", _HASHES.clear)


def words(text: str) -> np.ndarray:
    """The buckets of each word, in one number."""
    return np.fromiter(map(_HASHES.__getitem__, WORD.findall(text.lower())), np.int64)


def buckets(seen: np.ndarray) -> list[np.ndarray]:
    """One index per table."""
    return [seen >> 16 * k & BUCKETS - 1 for k in range(TABLES)]


@dataclass
class Network:
    embedded: list[np.ndarray]
    filters: list[np.ndarray]  # for each width: (width, TABLES * DIMS, FILTERS)
    offsets: list[np.ndarray]
    out: np.ndarray
    bias: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    cuts: dict[str, float] = field(default_factory=dict)
    tables: tuple | None = None

    def ready(self) -> Network:
        """Tables times filters; the last row stands for no word."""
        side = np.concatenate([w for f in self.filters for w in f], axis=1)
        pad = np.zeros((1, COLUMNS), np.float32)
        self.tables = tuple(np.vstack((t @ side[DIMS * k : DIMS * (k + 1)], pad)).astype(np.float32) for k, t in enumerate(self.embedded))
        return self

    def pooled(self, seen: np.ndarray) -> np.ndarray:
        """Largest value of each filter over the whole text, before the offsets."""
        best = np.full(FILTERS * len(WIDTHS), -np.inf, np.float32)
        wide = max(WIDTHS)
        at = buckets(seen)
        if len(seen) < wide:
            at = [np.append(x, np.full(wide - len(seen), BUCKETS)) for x in at]
        for k in range(0, max(1, len(at[0]) - wide + 1), BLOCK):
            parts = self.tables[0][at[0][k : k + BLOCK + wide - 1]]
            for table, x in zip(self.tables[1:], at[1:], strict=True):
                parts += table[x[k : k + BLOCK + wide - 1]]
            column = 0
            for n, width in enumerate(WIDTHS):
                run = parts[: len(parts) - width + 1, column : column + FILTERS].copy()
                for j in range(1, width):
                    c = column + FILTERS * j
                    run += parts[j : len(parts) - width + 1 + j, c : c + FILTERS]
                column += FILTERS * width
                own = slice(FILTERS * n, FILTERS * (n + 1))
                best[own] = np.maximum(best[own], run.max(0))
        return best

    def logit(self, seen: np.ndarray) -> float:
        hidden = np.maximum(self.pooled(seen) + np.concatenate(self.offsets), 0)
        return self.scale[0] * float(hidden @ self.out + self.bias) + self.scale[1]


def fit(rows: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Network:
    """Back-propagation through the largest windows, Adagrad, rows in random order."""
    rng = np.random.default_rng(seed)
    tables = []
    for k in range(TABLES):
        hits = np.zeros((2, BUCKETS))
        for seen, label in zip(rows, y, strict=True):
            hits[int(label), np.unique(buckets(seen)[k])] += 1
        odds = np.log((hits[1] + 0.5) / (y.sum() + 1)) - np.log((hits[0] + 0.5) / (len(y) - y.sum() + 1))
        total = hits.sum(0)
        table = rng.normal(0, 0.02, (BUCKETS, DIMS))
        table[:, 0] = np.clip(odds * total / (total + 6), -3, 3)
        tables.append(table)
    filters = [rng.normal(0, 0.1, (w, TABLES * DIMS, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[0, DIMS * np.arange(TABLES), np.arange(TABLES)] += 1.0  # at first a filter for each table's log odds
    offsets = [np.full(FILTERS, -1.0) for _ in WIDTHS]
    out = rng.normal(0, 0.1, FILTERS * len(WIDTHS))
    out[[FILTERS * n + k for n in range(len(WIDTHS)) for k in range(TABLES)]] = 0.5
    net = Network(tables, filters, offsets, out, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    seen_f, seen_o, seen_out, seen_b = [np.full(f.shape, 1e-2) for f in filters], [np.full(FILTERS, 1e-2) for _ in WIDTHS], np.full(len(out), 1e-2), 1e-2
    seen_t = [np.full((BUCKETS, DIMS), 1e-1) for _ in range(TABLES)]
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum())) * len(y)
    for _ in range(max(epochs, min(30, 8000 // max(1, len(rows))))):
        for i in rng.permutation(len(rows)):
            own = buckets(rows[i])
            tops, values = [], []
            for k in range(0, max(1, len(own[0]) - max(WIDTHS) + 1), BLOCK):
                x = np.concatenate([table[at[k : k + BLOCK + max(WIDTHS) - 1]] for table, at in zip(tables, own, strict=True)], axis=1)
                if len(x) < max(WIDTHS):
                    x = np.vstack((x, np.zeros((max(WIDTHS) - len(x), TABLES * DIMS))))
                for m, (f, o) in enumerate(zip(filters, offsets, strict=True)):
                    n = len(x) - len(f) + 1
                    run = sum(x[j : j + n] @ f[j] for j in range(len(f))) + o
                    top, value = run.argmax(0), run.max(0)
                    if k == 0:
                        tops.append(top)
                        values.append(value)
                    else:
                        tops[m] = np.where(value > values[m], top + k, tops[m])
                        values[m] = np.maximum(value, values[m])
            inputs = [[np.zeros((FILTERS, TABLES * DIMS)) for _ in f] for f in filters]  # the largest windows, before any table changes
            for top, found in zip(tops, inputs, strict=True):
                for j, window in enumerate(found):
                    real = top + j < len(own[0])
                    window[real] = np.concatenate([table[at[top[real] + j]] for table, at in zip(tables, own, strict=True)], axis=1)
            hidden = np.maximum(np.concatenate(values), 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ out + net.bias, -30, 30)))
            error = float((p - y[i]) * weight[i])
            back = error * out * (hidden > 0)
            g = error * hidden + 1e-4 * out
            seen_out += g * g
            out -= 0.05 * g / np.sqrt(seen_out)
            seen_b += error * error
            net.bias -= 0.05 * error / np.sqrt(seen_b)
            for n, (f, o) in enumerate(zip(filters, offsets, strict=True)):
                b = back[FILTERS * n : FILTERS * (n + 1)]
                if not b.any():
                    continue
                for j, window in enumerate(inputs[n]):
                    at = tops[n] + j
                    real = at < len(own[0])
                    gx = (b[:, None] * f[j].T)[real]
                    for t, table in enumerate(tables):
                        gt, rows_of = gx[:, DIMS * t : DIMS * (t + 1)], own[t][at[real]]
                        np.add.at(seen_t[t], rows_of, gt * gt)
                        np.add.at(table, rows_of, -0.02 * gt / np.sqrt(seen_t[t][rows_of]))
                    gf = (b[:, None] * window).T + 1e-4 * f[j]
                    seen_f[n][j] += gf * gf
                    f[j] -= 0.02 * gf / np.sqrt(seen_f[n][j])
                seen_o[n] += b * b
                o -= 0.02 * b / np.sqrt(seen_o[n])
    return net.ready()


def best_cut(bins: np.ndarray, clean: np.ndarray, toxic: np.ndarray, weight: tuple[float, float]) -> float:
    """The cut with the fewest errors, as a score; ``bins`` are distinct, with their rows of each class, which weigh ``weight``."""
    order = np.argsort(bins)
    bins, clean, toxic = bins[order], clean[order], toxic[order]
    cuts = np.concatenate(([bins[0] - BINS], (bins[:-1] + 1 + bins[1:]) / 2, [bins[-1] + 1 + BINS])) / BINS
    missed = np.concatenate(([0], np.cumsum(toxic)))
    wrong = clean.sum() - np.concatenate(([0], np.cumsum(clean)))
    loss = weight[1] * missed + weight[0] * wrong
    good = cuts[loss <= loss.min() + 1e-9 * max(1.0, loss.max())]
    cut = good[np.argmin(np.abs(good))]  # of equally good ones the nearest to one half
    cut *= toxic.sum() / (toxic.sum() + 30)  # with few positive rows it stays near one half
    return float(1 / (1 + np.exp(-cut)))


def calibrate(net: Network, rows: DataFrame, weight: tuple[float, float]) -> None:
    """A cut for each language of ``rows`` (text, lang, y), which weren't fitted; scores are binned and counted in Spark."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun("toxicity")
        for batch in batches:
            logits = np.array([shared.value.logit(words(x.as_py())) for x in batch.column(0)])
            bins = np.floor(np.clip(logits, -30, 30) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(bins)], ["lang", "y", "bin"])

    seen = rows.where("lang is not null").select("text", "lang", "y").mapInArrow(binned, "lang string, y int, bin int")
    counts = seen.groupBy("lang", "bin").agg(F.sum(1 - F.col("y")).alias("clean"), F.sum("y").alias("toxic"))
    for lang, part in counts.toPandas().groupby("lang"):  # bounded by languages and bins
        if part["toxic"].sum() >= 5 and part["clean"].sum() >= 5:
            net.cuts[lang] = best_cut(*(part[c].to_numpy(np.float64) for c in ("bin", "clean", "toxic")), weight)
    shared.destroy()


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: dict[int, int] = ROWS) -> Network | None:
    """A model of ``labels.toxic`` from at most ``rows[y]`` usable labelled rows of class y."""
    workers(docs.sparkSession)
    shares = {r.y: r.n for r in labels.where(usable & F.col("toxic").isNotNull()).groupBy(F.col("toxic").cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}  # a row per class
    if not shares.get(0) or not shares.get(1):
        return None
    drawn = sample(docs, labels, "toxic", usable, rows, id_col, text_col)

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun("toxicity")
        for batch in batches:
            found = [words(x.as_py()).tobytes() for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.binary())], ["id", "y", "words"])

    picked = drawn.select("text", F.xxhash64(id_col).alias("id"), "y").mapInArrow(made, "id long, y int, words binary")
    got = picked.toArrow().sort_by("id")  # a row for each drawn id, at most the sum of ``rows``
    seen, y = [np.frombuffer(x.as_buffer(), np.int64) for x in got["words"]], got["y"].to_numpy().astype(np.float64)
    if len(set(y.tolist())) < 2:
        return None
    numbers = got["id"].to_numpy()
    fitted = {k: [x for n, x in enumerate(numbers[y == k].tolist()) if n % 5 != 4] for k in (0, 1)}
    inside = {x for found in fitted.values() for x in found}
    kept = np.array([x in inside for x in numbers.tolist()])
    net = fit([s for s, k in zip(seen, kept, strict=True) if k], y[kept])
    net.embedded = []  # only their products with the filters are needed to score
    if len(set(y[~kept].tolist())) == 2:
        net.scale = platt(np.array([net.logit(s) for s, k in zip(seen, kept, strict=True) if not k]), y[~kept])
    del seen, got
    trimmed()
    if lang_col in docs.columns:
        out = docs.sparkSession.createDataFrame([(x,) for x in sorted(inside)], "fitted long")
        left = known(labels, "toxic", usable, id_col)
        left = left.join(F.broadcast(out), F.xxhash64(id_col) == F.col("fitted"), "left_anti")
        texts = docs.select(F.col(id_col), text_of(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
        weight = tuple(shares[k] / max(1, shares[k] - len(fitted[k])) for k in (0, 1))  # rows that weren't fitted stand for their whole class
        calibrate(net, texts.join(sized(left, sum(shares.values())), id_col), weight)
    return net


def score(docs: DataFrame, model: Network | None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id_col, score, predicted (cut at one half), language_cut, toxic (by the language's cut)."""
    spark = docs.sparkSession
    workers(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun("toxicity")
        net = shared.value
        for batch in batches:
            found = np.zeros(batch.num_rows)
            if net is not None:
                logits = np.array([net.logit(words(x.as_py())) for x in batch.column(1)])
                found = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(to_arrow_type(kind)), batch.column(2), pa.array(found)], ["id", "lang", "score"])

    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    out = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), lang.alias("lang"))
    out = out.mapInArrow(scored, f"id {kind.simpleString()}, lang string, score double")
    cut = F.lit(CUT)
    for name, value in (model.cuts if model is not None else {}).items():
        cut = F.when(F.col("lang") == name, F.lit(value)).otherwise(cut)
    out = out.select(F.col("id").alias(id_col), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), cut.alias("language_cut"))
    return out.withColumn("toxic", F.col("score") >= F.col("language_cut"))


def drop_toxic(df: DataFrame, model: Network | None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of ``df`` below their language's cut, all of them without a model; all columns stay."""
    workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def keep(batch: pa.RecordBatch) -> list[bool]:
        begun("toxicity")
        net = shared.value
        if net is None:
            return [True] * batch.num_rows
        langs = batch.column(batch.schema.get_field_index(lang_col)).to_pylist() if lang_col in batch.schema.names else [None] * batch.num_rows
        texts = batch.column(batch.schema.get_field_index(text_col))
        return [
            1 / (1 + np.exp(-np.clip(net.logit(words(x.as_py() or "")), -30, 30))) < net.cuts.get(lang, CUT) for x, lang in zip(texts, langs, strict=True)
        ]

    return filtered(df, keep)
