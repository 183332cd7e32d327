"""A bitmap of keys by which a second reading of the texts passes over rows without candidates.

A key has four places; all its bits may be other keys', so what it lets through (one in 400) is joined by key
afterwards.  It has 16 bits or more for each key up to ``MOST_BITS`` (16 MB, the bound of what is
broadcast), and beyond that fewer; once it would let nearly all pass there is none, and
the join does the work alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .hashing import mix
from .memory import trim, trimmed

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
PROBES = 4
_SHARD = 1 << 12
_U = np.uint64


def _places(keys: np.ndarray, bits: int):
    """The ``PROBES`` places of each key, by double hashing."""
    h = mix(keys.view(_U) + _U(1))
    step = (h >> _U(32)) | _U(1)
    for _ in range(PROBES):
        at = h & _U(bits - 1)
        yield (at >> _U(3)).astype(np.int64), np.uint8(1) << (at & _U(7)).astype(np.uint8)
        h = h + step


def _mark(bits: int):
    @trimmed
    def run(batches):
        held = np.zeros(bits // 8, np.uint8)
        for pdf in batches:
            for byte, bit in _places(pdf["key"].to_numpy(), bits):
                np.bitwise_or.at(held, byte, bit)
        shards = held.reshape(-1, _SHARD)
        some = np.flatnonzero(shards.any(axis=1)).astype(np.int32)
        yield pd.DataFrame({"shard": some, "bits": [shards[i].tobytes() for i in some.tolist()]})

    return run


def _join(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_SHARD, np.uint8)
    for b in pdf["bits"]:
        total |= np.frombuffer(b, np.uint8)
    return pd.DataFrame({"shard": pdf["shard"][:1], "bits": [total.tobytes()]})


def bitmap(keys: DataFrame) -> Broadcast | None:
    """The bitmap of the column ``key`` (64-bit hashes, not null), united in Spark and broadcast; none for too many keys."""
    n = keys.count()
    if n > MOST_BITS // 2:
        return None
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * n).bit_length()))
    schema = "shard int, bits binary"
    shards = keys.select("key").mapInPandas(_mark(bits), schema).groupBy("shard").applyInPandas(_join, schema)
    out = np.zeros((bits // 8 // _SHARD, _SHARD), np.uint8)
    for row in shards.collect():  # ``bits`` in all
        out[row["shard"]] = np.frombuffer(row["bits"], np.uint8)
    sent = keys.sparkSession.sparkContext.broadcast(out.ravel())
    del out
    trim()
    return sent


def marked(bits: Broadcast | None, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` may be in the bitmap; all if there is none."""
    if bits is None:
        return np.ones(len(keys), bool)
    held = bits.value
    out = np.ones(len(keys), bool)
    for byte, bit in _places(keys, 8 * len(held)):
        out &= (held[byte] & bit) != 0
    return out
