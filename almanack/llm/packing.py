"""Operator 4: conflict-constrained best-fit packing of documents into sequences.

Method: texts are cut into pieces of at most ``capacity`` words; a full piece is
a bin of its own, the rest are packed largest first.  Bins are kept in order
of their residual and carry bitmaps of the sources and duplicate clusters they
hold.  A piece goes to the tightest bin it fits that shares neither bit; the
search goes on from bin to successor until it finds one, else opens a bin.

A source with more pieces than its block has bins at best gets several lanes,
each with its own bit, so a source that holds a third of all rows is spread evenly
and does not force bins open.  Duplicate clusters are equal texts up to
case and white space.

Scale: pieces are dealt by hash to blocks of a few thousand, packed apart; a
block's last bins are the only loss.  No text moves: only word counts do.

Null and empty texts, and texts of white space, have no pieces: one row with
null bin.  A very long text has many pieces, each in a bin of its own but the last.  Null sources are a source; rows may repeat (they are one cluster, and
are numbered, so that reruns and other file splits pack alike); an
empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import n_words, settle, ship, table

CAPACITY = 2048
#: Pieces of a block, on average.
BLOCK = 4096


def best_fit(sizes: np.ndarray, source: np.ndarray, cluster: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, taken in the order given.

    ``source`` and ``cluster`` number what conflicts with its like; cluster -1 conflicts with nothing.
    """
    n = len(sizes)
    words = (np.maximum(source.max(initial=0), cluster.max(initial=0)) >> 6) + 1
    # residuals in order; bins, source bits and cluster bits lie alongside
    residual, number = np.empty(n, np.int64), np.empty(n, np.int64)
    bits = np.zeros((n, 2, int(words)), np.uint64)  # by bin
    opened = 0
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, (size, s, c) in enumerate(zip(sizes.tolist(), source.tolist(), cluster.tolist())):
        at = int(np.searchsorted(residual[:opened], size))
        chosen = -1
        while at < opened:  # successors, a stretch at a time
            stop = min(opened, at + 64)
            some = number[at:stop]
            clash = bits[some, 0, s >> 6] & np.uint64(1 << (s & 63))
            if c >= 0:
                clash = clash | (bits[some, 1, c >> 6] & np.uint64(1 << (c & 63)))
            free = np.flatnonzero(clash == 0)
            if len(free):
                chosen = at + int(free[0])
                break
            at = stop
        if chosen < 0:
            b, left = opened, capacity
            opened += 1
            chosen = opened - 1
        else:
            b, left = int(number[chosen]), int(residual[chosen])
        bins[k], offsets[k] = b, capacity - left
        bits[b, 0, s >> 6] |= np.uint64(1 << (s & 63))
        if c >= 0:
            bits[b, 1, c >> 6] |= np.uint64(1 << (c & 63))
        left -= size
        to = int(np.searchsorted(residual[:chosen], left))
        residual[to + 1 : chosen + 1] = residual[to:chosen]
        number[to + 1 : chosen + 1] = number[to:chosen]
        residual[to], number[to] = left, b
    return bins, offsets


def lanes(sizes: np.ndarray, source: np.ndarray, capacity: int) -> np.ndarray:
    """Numbers of (source, lane): the pieces of a source take turns among as many lanes as it needs."""
    at_best = max(1, -(-int(sizes.sum()) // capacity))
    _, number, count = np.unique(source, return_inverse=True, return_counts=True)
    order = np.argsort(number, kind="stable")
    turn = np.empty(len(sizes), np.int64)
    turn[order] = np.arange(len(sizes)) - (np.cumsum(count) - count)[number[order]]
    most = -(-count // at_best)
    base = np.cumsum(most) - most
    return base[number] + turn % most[number]


_OUT = "row_id long, piece int, words int, block long, bin long, start int"


def _pack(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["words", "order", "copy", "piece"], ascending=[False, True, True, True], ignore_index=True)
        sizes = pdf["words"].to_numpy(np.int64)
        _, cluster, count = np.unique(pdf["cluster"].to_numpy(), return_inverse=True, return_counts=True)
        several = np.cumsum(count > 1) - 1
        cluster = np.where(count[cluster] > 1, several[cluster], -1)
        whole = sizes == capacity
        bins, start = np.empty(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        bins[whole] = np.arange(whole.sum())
        if (~whole).any():
            rest = ~whole
            source = lanes(sizes[rest], pdf["source"].to_numpy()[rest], capacity)
            b, start[rest] = best_fit(sizes[rest], source, cluster[rest], capacity)
            bins[rest] = b + whole.sum()
        return pd.DataFrame({"row_id": pdf["row_id"], "piece": pdf["piece"], "words": sizes, "block": pdf["block"], "bin": bins, "start": start})

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``doc_id, source, piece, words, bin, start``: where each piece of each document goes.

    ``piece`` numbers the pieces of ``capacity`` words from 0, ``bin`` is
    "block/bin", ``start`` the piece's first word in it.
    """
    ship(docs.sparkSession)
    plain = F.lower(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")))
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("n"), F.xxhash64(plain).alias("cluster"), F.xxhash64("doc_id", "source", "text").alias("order"))
    # rows that are alike are numbered by counting them, not by their place in a file
    alike = rows.groupBy("doc_id", "source", "n", "cluster", "order").agg(F.count(F.lit(1)).alias("copies"))
    rows = alike.select("doc_id", "source", "n", "cluster", "order", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    rows = settle(rows.withColumn("row_id", F.monotonically_increasing_id()), "sizes")
    pieces = rows.where("n > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity).cast("int"))))
    pieces = pieces.withColumn("words", F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).cast("int"))
    # as many words as a block of ordinary pieces has, whatever the lengths
    total = rows.agg(F.sum(F.floor((F.col("n") + capacity - 1) / capacity))).first()[0] or 0
    blocks = max(1, -(-int(total) // block))
    pieces = pieces.select("row_id", "piece", "words", "cluster", "order", "copy", F.xxhash64(F.coalesce("source", F.lit("\0"))).alias("source"), F.pmod(F.xxhash64("order", "copy", "piece"), F.lit(blocks)).alias("block"))
    packed = pieces.groupBy("block").applyInPandas(_pack(capacity), _OUT)
    # the ids come back by a join on the row, one row per piece
    placed = rows.select("row_id", "doc_id", "source").join(packed, "row_id", "left")
    return placed.select("doc_id", "source", "piece", "words", F.concat_ws("/", "block", F.col("bin").cast("string")).alias("bin"), "start").withColumn("bin", F.when(F.col("piece").isNotNull(), F.col("bin")))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into bins of 2048 words."""
    return pack(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


QUERIES = {"op4_best_fit_packing": op4_best_fit_packing}
SQL: dict[str, str] = {}
