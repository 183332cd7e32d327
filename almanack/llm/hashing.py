"""Vectorised Rabin-Karp hashing of words and word windows.

Every function works on a batch of texts laid out in one byte buffer, so no
Python loop runs per word.  Hashes are 64-bit and depend on nothing but the
text: workers, batches and reruns agree.

A word is a run of bytes outside 0x20 and 0x09-0x0D (the same words as the
pattern ``[^\\x20\\x09-\\x0D]+`` over code points, since UTF-8 never uses those
bytes inside a longer code point).  A null text has no words.
"""

from __future__ import annotations

import functools

import numpy as np

#: Bytes hashed at once; a longer single word gets a block of its own.
BLOCK = 1 << 20
_U = np.uint64
_BYTE_BASE = _U(0x9E3779B97F4A7C15)
_WORD_BASE = _U(0xD1342543DE82EF95)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def _inverse(base: np.uint64) -> np.uint64:
    return _U(pow(int(base), -1, 1 << 64))


@functools.lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


def _pow(base: np.uint64, size: int) -> np.ndarray:
    grown = max(1 << 12, 1 << int(size - 1).bit_length())
    return _powers(int(base), grown)[:size]


@functools.lru_cache(maxsize=2)
def _table(fold: bool) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=_U) * _U(0x2545F4914F6CDD1D))
    if fold:
        table[65:91] = table[97:123]
    return table


def _spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a buffer that ends in a space."""
    space = SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def _hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    total = np.zeros(len(buf) + 1, _U)
    np.cumsum(_table(fold)[buf] * _pow(_BYTE_BASE, len(buf)), out=total[1:])
    return mix((total[end] - total[start]) * _pow(_inverse(_BYTE_BASE), len(buf))[start] + (end - start).astype(_U))


def words(texts, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and ``len(texts) + 1`` offsets into them.

    ``fold`` lower-cases A-Z only.  ``None`` and empty texts have no words.
    """
    parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    hashes, ends = [], [0]
    at, group, size = 0, [], 0

    def flush() -> None:
        nonlocal group, size
        if group:
            h, n = _hash_group(group, fold)
            hashes.append(h)
            ends.extend((ends[-1] + np.cumsum(n)).tolist())
        group, size = [], 0

    while at < len(parts):
        if size and size + len(parts[at]) > BLOCK:
            flush()
        group.append(parts[at])
        size += len(parts[at]) + 1
        at += 1
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, _U)), np.asarray(ends, np.int64)


def _hash_group(group: list[bytes], fold: bool) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(b" ".join([*group, b""]), np.uint8)
    if len(buf) == 0:
        return np.zeros(0, _U), np.zeros(len(group), np.int64)
    start, end = _spans(buf)
    bounds = np.zeros(len(group) + 1, np.int64)
    np.cumsum([len(g) + 1 for g in group], out=bounds[1:])
    counts = np.diff(np.searchsorted(start, bounds))
    out = np.empty(len(start), _U)
    at = 0
    while at < len(start):  # one long text is hashed block by block, cut between words
        base = int(start[at])
        stop = max(at + 1, int(np.searchsorted(end, base + BLOCK, "right")))
        piece = buf[base : int(end[stop - 1])]
        out[at:stop] = _hash_spans(piece, start[at:stop] - base, end[at:stop] - base, fold)
        at = stop
    return out, counts


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` consecutive word hashes (rolled by prefix sums)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.empty(n, _U)
    for at in range(0, n, BLOCK):
        piece = hashes[at : min(at + BLOCK, n) + width - 1]
        total = np.zeros(len(piece) + 1, _U)
        np.cumsum(piece * _pow(_WORD_BASE, len(piece)), out=total[1:])
        m = len(piece) - width + 1
        out[at : at + m] = mix((total[width:] - total[:m]) * _pow(_inverse(_WORD_BASE), m))
    return out


def window_index(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For texts laid out by ``offsets``: the positions at which a window lies inside one text, and its text."""
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(len(owner)) - first[owner] + offsets[:-1][owner], owner
