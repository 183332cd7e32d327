"""Operator 8: toxicity by naive Bayes log-count ratios of character n-grams in a linear classifier.

Method: features are the character n-grams (3 to 5) of the lower-cased text, present or
not, hashed to a fixed number of cells.  Each is scaled by its naive Bayes
log-count ratio, r = log of how much likelier it is in toxic texts; n-grams
whose two rates do not differ significantly have r = 0.  Logistic regression on
the scaled features gives the weights.  Fitted on a bounded labelled sample
(:mod:`.training`) of whole texts: executors count the n-grams of each class and find the
significant cells, the driver gets their ratios and which of them each text of the sample
has.  Scoring reads every whole text once, a very long one in pieces, and shuffles nothing.

Null and empty texts have no features and get the score of the intercept.
Rows may repeat; without labels of both classes all scores are constant; an empty table gives no
rows.  Ids keep their type; other columns are not read.  Labels, lang, source and doc_id are never features.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_mod, ship, table
from .memory import trim, trimmed
from .training import constant, labelled_sample

GRAMS = (3, 4, 5)
#: Feature cells: the model that is broadcast has this many weights of 4 bytes.
CELLS = 1 << 20
#: Standard errors by which the rates must differ.
SIGNIFICANT = 3.0
_PIECE = 1 << 19
_LOT = 256
_U = np.uint64
_BASE = _U(0x9FB21C651E98DF25)
_TOP = _U(0xD6E8FEB86659FD93)
#: Marks of (text, column) pairs held at once.
_MARKS = 1 << 26


def _pieces(texts):
    """(numbers of texts, texts) in lots of about ``_PIECE`` characters; a longer text is cut with an overlap."""
    numbers, lot, size = [], [], 0
    for k, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, max(len(text), 1), _PIECE):
            part = text[at : at + _PIECE + max(GRAMS) - 1]
            numbers.append(k)
            lot.append(part)
            size += len(part)
            if size >= _PIECE:
                yield np.array(numbers), lot
                numbers, lot, size = [], [], 0
    if lot:
        yield np.array(numbers), lot


def _cells(lot: list[str]):
    """For each n: the cell of every n-gram, whether it lies in one text, and its text in the lot."""
    sizes = np.array([len(t) for t in lot])
    chars = np.frombuffer("".join(lot).encode("utf-32-le", "surrogatepass"), "<u4").astype(_U)
    owner = np.repeat(np.arange(len(lot), dtype=np.int32), sizes)
    h = np.zeros(len(chars), _U)
    for n in range(1, max(GRAMS) + 1):
        if len(chars) < n:
            return
        h = h[: len(chars) - n + 1] * _BASE
        h += chars[n - 1 :]
        h += _U(1)
        if n in GRAMS:
            # the top bits of a product depend on all characters
            yield (((h + _U(n)) * _TOP) >> _U(44)).astype(np.int32), owner[: len(h)] == owner[n - 1 :], owner[: len(h)]


def columns(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each cell its number among those that ``wanted`` marks, or -1; and these cells."""
    used = np.flatnonzero(wanted)
    table = np.full(CELLS, -1, np.int32)
    table[used] = np.arange(len(used), dtype=np.int32)
    return table, used


def present(texts, table: np.ndarray | None = None, n_columns: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, cell) pairs, ordered; with a ``table`` of :func:`columns`, (text number, column) pairs of the cells in it."""
    width = CELLS if table is None else max(n_columns, 1)
    found, last = [], -1
    spread = False
    for numbers, lot in _pieces(texts):
        spread |= numbers[0] == last  # a very long text lies in several lots
        last = int(numbers[-1])
        rows = numbers - numbers[0]
        if table is None or (rows[-1] + 1) * width > _MARKS:
            found.append(np.unique(np.concatenate([numbers[owner[keep]] * width + cell[keep] for cell, keep, owner in _wanted(lot, table)] or [np.zeros(0, np.int64)])))
            continue
        held = np.zeros((int(rows[-1]) + 1) * width, bool)
        for cell, keep, owner in _wanted(lot, table):
            held[rows[owner[keep]] * width + cell[keep]] = True
        found.append(np.flatnonzero(held) + numbers[0] * width)
    pairs = np.concatenate(found) if found else np.zeros(0, np.int64)
    if spread:
        pairs = np.unique(pairs)
    return pairs // width, pairs % width


def _wanted(lot: list[str], table: np.ndarray | None):
    for cell, inside, owner in _cells(lot):
        if table is None:
            yield cell, inside, owner
        else:
            column = table[cell]
            yield column, inside & (column >= 0), owner


@trimmed
def _counted(batches):
    """How many texts of each class have a cell; nothing for cells that none has."""
    held = np.zeros((2, CELLS), np.int32)
    for pdf in batches:
        for at in range(0, len(pdf), _LOT):
            part = pdf.iloc[at : at + _LOT]
            rows, cells = present(part["text"].tolist())
            toxic = part["y"].to_numpy()[rows] == 1
            held[1] += np.bincount(cells[toxic], minlength=CELLS).astype(np.int32)
            held[0] += np.bincount(cells[~toxic], minlength=CELLS).astype(np.int32)
    cell = np.flatnonzero(held.any(axis=0))
    yield pd.DataFrame({"cell": cell.astype(np.int32), "n0": held[0, cell].astype(np.int64), "n1": held[1, cell].astype(np.int64)})


def _present(wanted):
    @trimmed
    def run(batches):
        table, used = columns(wanted.value)
        for pdf in batches:
            rows, column = present(pdf["text"].tolist(), table, len(used))
            ends = np.searchsorted(rows, np.arange(len(pdf) + 1))
            cells = used[column].astype(np.int32)
            yield pd.DataFrame({"row": pdf["row"], "y": pdf["y"], "cells": [cells[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]})

    return run


def ratios(counts: DataFrame, n1: int, n0: int) -> DataFrame:
    """``cell, r`` of the cells (``cell, n1, n0``: texts of each class that have it) whose rates differ significantly."""
    a, b = (F.col("n1") + 1) / (n1 + 2), (F.col("n0") + 1) / (n0 + 2)
    z = (a - b) / F.sqrt(a * (1 - a) / n1 + b * (1 - b) / n0)
    return counts.where((F.abs(z) >= SIGNIFICANT) & (F.col("n1") + F.col("n0") >= 5)).select("cell", F.ln(a / b).alias("r"))


def fitted(sample: DataFrame) -> tuple[np.ndarray, float] | float:
    """Weights and intercept from a sample (``row, y, text``), or the score of everything where there is nothing to learn."""
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    fixed = constant(np.repeat([1, 0], [n1, n0]))
    if fixed is not None:
        return fixed
    counts = sample.select("y", "text").mapInPandas(_counted, "cell int, n0 long, n1 long").groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    found = ratios(counts, n1, n0).toPandas()  # CELLS rows at most
    r = np.zeros(CELLS)
    r[found["cell"]] = found["r"]
    wanted = sample.sparkSession.sparkContext.broadcast(r != 0)
    found = sample.select("row", "y", "text").mapInPandas(_present(wanted), "row long, y int, cells binary").toPandas()  # a bounded sample's significant cells
    found = found.sort_values(["row", "y", "cells"], ignore_index=True)
    ends = np.concatenate(([0], np.cumsum([len(c) // 4 for c in found["cells"]])))
    cells, y = np.frombuffer(b"".join(found["cells"]), np.int32), found["y"].to_numpy(np.int64)
    del found
    trim()
    return fit(ends, cells, y, r)


def fit(ends: np.ndarray, cells: np.ndarray, y: np.ndarray, r: np.ndarray, steps: int = 150, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights of all cells (scaled by their ratios ``r``) and the intercept, from the cells of each text (those of text i end at ``ends[i + 1]``).

    The cells are passed through in lots of texts, so only they are held, four bytes each.
    """
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    held = np.zeros(CELLS, bool)
    held[cells] = True
    used = np.flatnonzero(held)
    place = np.zeros(CELLS, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    column, ratio = place[cells], r[used]
    lots = [(k, min(k + _LOT, len(y))) for k in range(0, len(y), _LOT)]
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)  # both classes count the same
    w, c = np.full(len(used), 0.05), 0.0
    m, v, mc, vc = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for t in range(1, steps + 1):  # Adam, full batch
        g, gc, scaled = np.zeros(len(used)), 0.0, w * ratio
        for low, high in lots:
            own, counts = column[ends[low] : ends[high]], np.diff(ends[low : high + 1])
            rows = np.repeat(np.arange(high - low), counts)
            margin = np.bincount(rows, weights=scaled[own], minlength=high - low) + c
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[low:high]) * weight[low:high]
            g += np.bincount(own, weights=error[rows], minlength=len(used))
            gc += error.sum()
        g = g * ratio + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mc, vc = 0.9 * mc + 0.1 * gc, 0.99 * vc + 0.01 * gc * gc
        k1, k2 = 1 - 0.9**t, 1 - 0.99**t
        w -= 0.03 * (m / k1) / (np.sqrt(v / k2) + 1e-8)
        c -= 0.03 * (mc / k1) / (np.sqrt(vc / k2) + 1e-8)
    out = np.zeros(CELLS, np.float32)
    out[used] = w * ratio
    return out, float(c)


def _score(model):
    @trimmed
    def run(batches):
        weights, intercept = model.value
        table, used = columns(weights != 0)
        weights = weights[used]
        for pdf in batches:
            texts = pdf["text"].tolist()
            rows, column = present(texts, table, len(used))
            margin = np.bincount(rows, weights=weights[column], minlength=len(texts)) + intercept
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": 1 / (1 + np.exp(-np.clip(margin, -30, 30)))})

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``, learnt from ``labels`` (``doc_id, toxic``)."""
    spark = docs.sparkSession
    ship(spark)
    own_type = docs.schema["doc_id"].dataType
    model = fitted(labelled_sample(docs, labels, "toxic", 5, 0))
    trim()  # the driver keeps the weights only
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    if isinstance(model, float):
        scored = rows.select("doc_id", F.lit(model).alias("score"))
    else:
        scored = rows.mapInPandas(_score(spark.sparkContext.broadcast(model)), "doc_id string, score double")
    return scored.select(F.col("doc_id").cast(own_type).alias("doc_id"), (crc32_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents for toxicity."""
    return toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


QUERIES = {"op8_toxicity": op8_toxicity}
SQL: dict[str, str] = {}
