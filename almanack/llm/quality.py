"""Operator 10: quality by a factorisation machine.

Method: features are hashed words (square root of their share of the text),
structure statistics of the text, and as metadata ``n_chars`` (the text's length where that is missing).  The machine adds to a linear model the
interactions of all pairs of features, each weighted by the product of two
low-rank vectors; they are summed in linear time as half of (square of the sum
minus sum of the squares).  Fitted by Adam on a bounded labelled sample
(:mod:`.training`) of whole texts, whose features executors compute; scoring reads every whole text once and shuffles nothing.

Null and empty texts have only structure features; a very long one is hashed in pieces.  Rows may repeat; without labels of
both classes all scores are constant; an empty table gives no rows.  Ids keep their type.  Labels,
lang, source and doc_id are never features; other columns pass unread, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import hashing as H
from .common import crc32_mod, ship, table
from .memory import trim, trimmed
from .training import constant, labelled_sample

WORD_CELLS = 1 << 15
RANK = 8
#: Texts whose features are held at once.
LOT = 500
_BYTES = np.zeros((5, 256), np.float32)
for _row, _what in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?", b"\n", b"|#*%$&<>{}[]=~^\\/@_")):
    _BYTES[_row, list(_what)] = 1
STATS = 13


def structure(texts, words: np.ndarray, offsets: np.ndarray, cells, metadata) -> np.ndarray:
    """Statistics of each text, one row each."""
    rows, cell, count = cells
    n = np.diff(offsets).astype(float)
    some = np.maximum(n, 1)
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(r) for r in raw], float)
    out = np.zeros((len(raw), STATS))
    out[:, 0] = np.log1p(n)
    out[:, 1] = size / some
    out[:, 2] = np.bincount(rows, minlength=len(raw)) / some
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    again[starts] = False
    owner = np.repeat(np.arange(len(raw)), np.diff(offsets))
    out[:, 3] = np.bincount(owner[again], minlength=len(raw)) / some
    top = np.zeros(len(raw))
    np.maximum.at(top, rows, count)
    out[:, 4] = top / some
    for k, text in enumerate(raw):
        if text:
            kinds = _BYTES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float32)
            out[k, 5:10] = kinds / len(text)
            out[k, 10] = np.log1p(len(text) / (1 + kinds[3]))
            out[k, 11] = text.count(b"http") / some[k]
    out[:, 12] = np.log1p(np.maximum(np.nan_to_num(metadata.astype(float)), 0))
    return out


def features(texts, metadata):
    """(text number, cell, value) of the hashed words, and the statistics."""
    words, offsets = H.words(texts, fold=True)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    pairs, count = np.unique(owner * WORD_CELLS + (words >> np.uint64(49)).astype(np.int64), return_counts=True)
    rows, cell = pairs // WORD_CELLS, pairs % WORD_CELLS
    value = np.sqrt(count / np.maximum(np.diff(offsets), 1)[rows])
    return rows, cell, value, structure(texts, words, offsets, (rows, cell, count), np.asarray(metadata))


class Machine:
    """``margin = bias + sum w x + (sum over factors of (sum v x)^2 - sum (v x)^2) / 2`` over words and statistics."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.bias = np.zeros(1)
        self.w, self.v = np.zeros(WORD_CELLS), rng.normal(0, 0.05, (WORD_CELLS, RANK))
        self.ws, self.vs = np.zeros(STATS), rng.normal(0, 0.05, (STATS, RANK))

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -4, 4) / 2

    def _sums(self, rows, cell, value, s, n):
        vx = self.v[cell] * value[:, None]
        first = np.stack([np.bincount(rows, weights=vx[:, k], minlength=n) for k in range(RANK)], 1) + s @ self.vs
        second = np.bincount(rows, weights=(vx * vx).sum(1), minlength=n) + (s * s) @ (self.vs * self.vs).sum(1)
        return first, second

    def margin(self, rows, cell, value, s) -> np.ndarray:
        n = len(s)
        first, second = self._sums(rows, cell, value, s, n)
        linear = np.bincount(rows, weights=self.w[cell] * value, minlength=n) + s @ self.ws
        return self.bias[0] + linear + 0.5 * ((first * first).sum(1) - second)

    def fit(self, rows, cell, value, s, y, epochs: int = 8, size: int = 256, rate: float = 0.02, penalty: float = 2e-4) -> None:
        rng = np.random.default_rng(3)
        cut = np.searchsorted(rows, np.arange(len(y) + 1))
        n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())
        weight = np.where(y == 1, 0.5 * len(y) / n1, 0.5 * len(y) / n0)
        names = ("bias", "w", "v", "ws", "vs")
        moments = {k: (np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))) for k in names}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), size):
                some = order[at : at + size]
                counts = cut[some + 1] - cut[some]
                pick = np.repeat(cut[some] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                r, c, x, st = np.repeat(np.arange(len(some)), counts), cell[pick], value[pick], s[some]
                first, _ = self._sums(r, c, x, st, len(some))
                error = (1 / (1 + np.exp(-np.clip(self.margin(r, c, x, st), -30, 30))) - y[some]) * weight[some] / len(some)
                ex = error[r] * x
                g = {"bias": error.sum(keepdims=True), "ws": st.T @ error, "w": np.bincount(c, weights=ex, minlength=WORD_CELLS)}
                gv = ex[:, None] * (first[r] - self.v[c] * x[:, None])
                g["v"] = np.stack([np.bincount(c, weights=gv[:, k], minlength=WORD_CELLS) for k in range(RANK)], 1)
                g["vs"] = st.T @ (error[:, None] * first) - ((st * st).T @ error)[:, None] * self.vs
                t += 1
                for k in names:
                    p, (m, v) = getattr(self, k), moments[k]
                    d = g[k] + (penalty * p if k != "bias" else 0)
                    m += 0.1 * (d - m)
                    v += 0.01 * (d * d - v)
                    p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)


def _length(docs: DataFrame) -> Column:
    """The metadata: ``n_chars``, or the length of the text where that is missing or not a number."""
    length = F.coalesce(F.length("text"), F.lit(0)).cast("double")
    return F.coalesce(F.expr("try_cast(n_chars as double)"), length) if "n_chars" in docs.columns else length


@trimmed
def _featured(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, LOT):
            part = batch.slice(at, LOT)
            rows, cell, value, stats = features(part.column("text").to_pylist(), part.column("length").to_numpy(zero_copy_only=False))
            ends = np.searchsorted(rows, np.arange(part.num_rows + 1))
            cell, value = cell.astype(np.int32), value.astype(np.float32)
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()) for x in (cell, value)]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("y"), *packed, pa.array([x.tobytes() for x in stats], pa.binary())], ["row", "y", "cells", "shares", "stats"])


def fitted(docs: DataFrame, labels: DataFrame) -> Machine | float:
    """The machine, or the score of everything where there is nothing to learn."""
    sample = labelled_sample(docs, labels, "quality", 3, 1)
    rows = sample.select("row", "y", "text", _length(sample).alias("length"))
    found = rows.mapInArrow(_featured, "row long, y int, cells binary, shares binary, stats binary").toPandas()  # of a bounded sample
    found = found.sort_values(["row", "y", "cells"], ignore_index=True)
    y = found["y"].to_numpy(np.int64)
    fixed = constant(y)
    if fixed is not None:
        return fixed
    sizes = np.array([len(c) // 4 for c in found["cells"]], np.int64)
    cell, value = (np.frombuffer(b"".join(found[c]), kind) for c, kind in (("cells", np.int32), ("shares", np.float32)))
    stats = np.frombuffer(b"".join(found["stats"]), np.float64).reshape(-1, STATS)
    machine = Machine(stats.mean(0), np.maximum(stats.std(0), 1e-6))
    machine.fit(np.repeat(np.arange(len(y)), sizes), cell, value.astype(np.float64), machine.scaled(stats), y)
    del found, cell, value
    trim()  # the driver keeps the machine only
    return machine


def _scores(machine: Machine, batch: pa.RecordBatch) -> np.ndarray:
    out = []
    for at in range(0, batch.num_rows, LOT):
        part = batch.slice(at, LOT)
        rows, cell, value, stats = features(part.column("text").to_pylist(), part.column("length").to_numpy(zero_copy_only=False))
        out.append(1 / (1 + np.exp(-np.clip(machine.margin(rows, cell, value, machine.scaled(stats)), -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


def _append(model):
    @trimmed
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(model.value, batch))], ["doc_id", "score"])

    return run


def _keep(model):
    @trimmed
    def run(batches):
        for batch in batches:
            scores = _scores(model.value, pa.RecordBatch.from_arrays([batch.column("row").field("text"), batch.column("length")], ["text", "length"]))
            yield batch.filter(pa.array(scores >= 0.5)).select(["row"])

    return run


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``, learnt from ``labels`` (``doc_id, quality``)."""
    spark = docs.sparkSession
    ship(spark)
    machine = fitted(docs, labels)
    rows = docs.select("doc_id", "text", _length(docs).alias("length"))
    if isinstance(machine, float):
        scored = rows.select("doc_id", F.lit(machine).alias("score"))
    else:
        schema = T.StructType([*rows.select("doc_id").schema.fields, T.StructField("score", T.DoubleType())])
        scored = rows.mapInArrow(_append(spark.sparkContext.broadcast(machine)), schema)
    return scored.select("doc_id", (crc32_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not rejected, with all their columns."""
    spark = docs.sparkSession
    ship(spark)
    machine = fitted(docs, labels)
    if isinstance(machine, float):
        return docs if machine >= 0.5 else docs.limit(0)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), _length(docs).alias("length"))
    kept = rows.mapInArrow(_keep(spark.sparkContext.broadcast(machine)), rows.select("row").schema)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents for quality."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op10_quality": op10_quality}
SQL: dict[str, str] = {}
