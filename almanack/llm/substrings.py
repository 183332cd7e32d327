"""Operator 6: substring dedup by Rabin-Karp windows.

Method: every window of ``width`` consecutive words of every text gets a
Rabin-Karp hash, rolled by prefix sums.  Spark deals the hashes to buckets by
their top bits and counts there in how many places each begins; a window that
begins more than once marks its words, and marked windows that touch merge into
maximal removal intervals.

Shape of the work, since there are about as many windows as words: documents
are dealt to chunks of a few MB by hash.  A chunk sends each bucket the distinct
hashes it holds, packed, seven bytes each (the bucket is the eighth or more).  A
window that a third of all documents share is sent once per chunk, so no key is
hot.  A bucket answers each chunk with one bit per hash: seen in another chunk
or not.  Repeats inside a chunk the chunk sees itself.  The same exchange of
texts serves both passes.  Chunks and buckets are numerous enough that either
fits a worker, whatever the input; a text longer than a chunk is a chunk
of its own size.

Null and empty texts have no words and lose none.  Rows may repeat: equal rows
hold the same windows at different places, so all of them count as repeats.
Ids keep their type.  An empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hashing as H
from .common import ship, table
from .memory import trimmed

WIDTH = 35
#: Bytes of text per chunk, and windows per bucket, aimed at.
CHUNK_BYTES = 4 << 20
BUCKET_WINDOWS = 1 << 20

_SENT = "bucket int, chunk long, keys binary"
_OUT = "doc_id string, n_words long, spans array<struct<start:int,end:int>>, kept_text string"


def _chunk_windows(texts, width: int):
    """Word offsets of the texts, window places and hashes, the distinct hashes and each window's number among them."""
    hashes, offsets = H.words(texts)
    at, owner = H.window_index(offsets, width)
    if len(at) == 0:
        return offsets, at, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct, number, count = np.unique(H.windows(hashes, width)[at], return_inverse=True, return_counts=True)
    return offsets, at, distinct, number, count


def _send(width: int, bits: int):
    @trimmed
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, distinct, _, _ = _chunk_windows(pdf["text"].tolist(), width)
        bucket = (distinct >> np.uint64(64 - bits)).astype(np.int32)
        cut = np.flatnonzero(np.diff(bucket)) + 1
        first = np.concatenate(([0], cut)).astype(np.int64) if len(bucket) else np.zeros(0, np.int64)
        low = np.ascontiguousarray(distinct.view(np.uint8).reshape(-1, 8)[:, :7])  # little-endian: the top byte is in the bucket
        ends = np.append(first[1:], len(bucket))
        return pd.DataFrame({"bucket": bucket[first], "chunk": np.full(len(first), key[0], np.int64), "keys": [low[a:b].tobytes() for a, b in zip(first, ends)]})

    return run


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    sizes = np.array([len(k) // 7 for k in pdf["keys"]])
    wide = np.zeros((int(sizes.sum()), 8), np.uint8)
    wide[:, :7] = np.frombuffer(b"".join(pdf["keys"]), np.uint8).reshape(-1, 7)
    keys = wide.view(np.uint64).ravel()
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    seen = np.zeros(len(keys), bool)
    seen[order[1:][same]] = True
    seen[order[:-1][same]] = True
    bits = np.split(seen, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"bucket": pdf["bucket"], "chunk": pdf["chunk"], "keys": [np.packbits(b).tobytes() for b in bits]})


def _remove(width: int, bits: int):
    @trimmed
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts = docs["text"].tolist()
        offsets, at, distinct, number, count = _chunk_windows(texts, width)
        repeated = count > 1
        if len(distinct):
            bounds = np.searchsorted(distinct >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            for bucket, answer in zip(answers["bucket"], answers["keys"]):
                a, b = int(bounds[bucket]), int(bounds[bucket + 1])
                repeated[a:b] |= np.unpackbits(np.frombuffer(answer, np.uint8), count=b - a).astype(bool)
        edge = np.zeros(int(offsets[-1]) + 1, np.int64)
        starts = at[repeated[number]] if len(at) else at
        edge[starts] += 1
        edge[starts + width] -= 1  # one window per place, and each lies inside one text
        gone = np.cumsum(edge)[:-1] > 0
        spans, kept = [], []
        for text, a, b in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist()):
            words = b"" if text is None else text.encode("utf-8", "surrogatepass")
            words, lost = words.split(), gone[a:b]
            if not lost.any():
                spans.append([])
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                continue
            turn = np.flatnonzero(np.diff(np.concatenate(([0], lost.view(np.int8), [0]))))
            spans.append([{"start": s, "end": e} for s, e in zip(turn[0::2].tolist(), turn[1::2].tolist())])
            kept.append(b" ".join([w for w, out in zip(words, lost.tolist()) if not out]).decode("utf-8", "surrogatepass"))
        return pd.DataFrame({"doc_id": docs["doc_id"], "n_words": np.diff(offsets), "spans": spans, "kept_text": kept})

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, spans, kept_text`` for every row of ``docs`` (``doc_id``, ``text``).

    ``spans`` are the maximal removal intervals, word numbers from 0, ends
    exclusive; ``kept_text`` is the words outside them, joined by one space.
    """
    ship(docs.sparkSession)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-size // CHUNK_BYTES))
    bits = min(22, max(8, int(size // 4 // BUCKET_WINDOWS).bit_length()))
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"))
    # both passes read the same exchange
    dealt = rows.repartition("chunk")
    sent = dealt.groupBy("chunk").applyInPandas(_send(width, bits), _SENT)
    answers = sent.groupBy("bucket").applyInPandas(_count, _SENT)
    out = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_remove(width, bits), _OUT)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes repeated passages of 35 words or more from all documents."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {"op6_substring_dedup": op6_substring_dedup}
SQL: dict[str, str] = {}
