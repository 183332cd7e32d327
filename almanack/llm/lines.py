"""Operator 9: fuzzy line dedup by MinHash.

Method: a line's set is its distinct runs of five characters.  One hash per
run fills a signature of 80 bins (one-permutation MinHash; an empty bin takes the value of
another that hashing picks); each band of five whole bins is a key, and lines that share
a key meet.  Very short lines also meet by exact keys: their set, and their set without any one run.
All pairs that meet are looked at, but for those that a sketch of 128 bits tells apart
(:func:`sketches`); components of the others are blocks, cut into bounded
tasks, in which the exact Jaccard coefficient of the whole sets alone decides (0.8
or more links).  A block too large for a task is taken apart again: its
lines are compared key by key.  Links are united by star contraction
(:func:`.common.components`), and of each component one line stays: the first
by document id and line number.  At a coefficient of 0.8 the sixteen bands miss
two in a thousand pairs, and the sketches one in a hundred thousand; nothing else is lost.

A first reading counts keys and lines, a second one keeps only lines that come again or share a key with
others; most do neither, and need no decision.

Lines are what lies between newlines; blank lines are no lines, they stay.
Equal lines (by 128 bits of hash and length) are one class from the start, so a line that a third of all
documents hold costs one row per task.  Texts are shuffled once, to be rewritten.

Null and empty texts stay as they are.  Equal rows (id and text) become one: of those that differ
in other columns the first by hash of the row. A
document that loses its last line that is not blank is a duplicate as a whole and
goes.  Ids keep their type; null ids come after all others.  Other columns pass unread, whatever their names.
A very long text is read in stretches of lines; a line is never cut.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing as H
from . import marks
from .blocks import block_tasks
from .common import Tables, components, settle, ship, table
from .memory import trimmed

RUN = 5
BINS = 80
BAND = 5
PERCENT = 80
#: Sets of at most so many runs also meet by exact keys.
TINY = 10
#: Bins not borrowed from which on a sketch is of the signature, the bins it holds, and how many of them must
#: agree in two such sketches: two bits a bin agree in 54 of 64 at a coefficient of 0.8, with a deviation of 2.9.
OWN, SKETCHED, AGREE = 56, 64, 41
#: Lines of a key in a task; rows with keys in a task; keys sent at once.
MEET, MEET_ROWS, SENT = 2048, 1 << 17, 1 << 21
#: Bytes of text for each key, about.
KEY_BYTES = 12
TASK_RUNS = 1 << 19
#: Characters of which blank lines are made, as in ``str.isspace``.
BLANK = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters hashed at once.
SLICE = 1 << 16
_U = np.uint64
_BASE = _U(0x2127599BF4325C37)
_BASE_2 = _U(0x2127599BF4325C37**2 % (1 << 64))
_TOP = _U(0xD6E8FEB86659FD93)
_BAND_FACTORS = H.mix(np.arange(1, BAND + 1, dtype=_U)) | _U(1)
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def _batches(texts: list):
    """(texts' numbers of lines, line numbers, lines) for lots of about half a million characters."""
    owner, number, lines, size = [], [], [], 0
    for k, text in enumerate(texts):
        if not text:
            continue
        for i, line in enumerate(text.split("\n")):
            if line and not line.isspace():
                owner.append(k)
                number.append(i)
                lines.append(line)
                size += len(line)
                if size > 1 << 19:
                    yield np.array(owner), np.array(number), lines
                    owner, number, lines, size = [], [], [], 0
    if lines:
        yield np.array(owner), np.array(number), lines


def _slices(lines: list[str]):
    """Bounds of stretches of ``lines`` whose arrays stay in a core's cache."""
    ends = np.cumsum([len(x) for x in lines])
    low = 0
    while low < len(lines):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + SLICE, "right")))
        yield low, high
        low = high


def _line_hashes(lines: list[str]) -> np.ndarray:
    """128 bits of each line, as two longs."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines]), np.int64).reshape(-1, 2)


def _runs(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``RUN`` characters of each line and the lines they are of; a shorter line is one run."""
    sizes = np.array([len(x) for x in lines])
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    n, counts = len(chars), np.maximum(sizes - RUN + 1, 1)
    owner = np.repeat(np.arange(len(lines)), counts)
    padded = np.ones(n + RUN, _U)
    padded[:n] += chars
    # a polynomial of five characters, from those of two
    two = padded[:-1] * _BASE
    two += padded[1:]
    h = two[:n] * _BASE_2
    h += two[2 : n + 2]
    h *= _BASE
    h += padded[4 : n + 4]
    # no run starts at a line's last characters
    ends, starts, keep = np.cumsum(sizes), np.cumsum(counts) - counts, np.ones(n, bool)
    for k in range(1, RUN):
        keep[ends[sizes > k] - k] = False
    hashes = h[keep]
    short = np.flatnonzero(sizes < RUN)
    if len(short):
        hashes[starts[short]] = [hash_short(lines[i]) for i in short.tolist()]
    # high bits name a bin, low bits are its value: both depend on all characters
    spare = np.right_shift(hashes, _U(29), out=h[: len(hashes)])
    hashes ^= spare
    hashes *= _TOP
    hashes ^= np.right_shift(hashes, _U(32), out=spare)
    return hashes, owner


def hash_short(line: str) -> int:
    out = len(line)
    for c in line:
        out = (out * int(_BASE) + ord(c) + 1) % (1 << 64)
    return out


def _borrowed() -> np.ndarray:
    """For each bin the order in which the others are asked when it is empty."""
    rng = np.random.default_rng(17)
    return np.stack([rng.permutation(BINS) for _ in range(BINS)])


_ASKED = np.ascontiguousarray(_borrowed().T)


def _filled(some: np.ndarray) -> np.ndarray:
    """Signatures in which an empty bin takes the value of the first that isn't, in an order of its own."""
    flat = some.ravel()
    out, at = flat.copy(), np.flatnonzero(flat == _EMPTY)
    bin_ = at % BINS
    row = at - bin_
    for asked in _ASKED:
        found = flat.take(row + asked.take(bin_))
        empty = found == _EMPTY
        out[at] = found  # what is still empty is asked again
        at, bin_, row = at.compress(empty), bin_.compress(empty), row.compress(empty)
        if not len(at):
            break
    return out.reshape(some.shape)


def signatures(lines: list[str]) -> np.ndarray:
    """The least hash of each line's runs in each of ``BINS`` bins."""
    some = np.full((len(lines), BINS), _EMPTY, _U)
    for low, high in _slices(lines):
        _sign(*_runs(lines[low:high]), some[low:high])
    return _complete(some)[0]


def _sign(hashes: np.ndarray, owner: np.ndarray, out: np.ndarray) -> None:
    """The least hash of each bin into ``out``."""
    bins = hashes >> _U(32)
    bins *= _U(BINS)
    bins >>= _U(32)
    at = owner * BINS
    at += bins.view(np.int64)
    np.minimum.at(out.reshape(-1), at, np.bitwise_and(hashes, _U(0xFFFFFFFF), out=bins))


def _own(some: np.ndarray) -> np.ndarray:
    return np.count_nonzero(some != _EMPTY, axis=1)


def _complete(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures with their empty bins filled, and how many bins of each are not borrowed."""
    own = _own(some)
    gaps = np.flatnonzero(own < BINS)
    some[gaps] = _filled(some[gaps])
    return some, own


def sketches(hashes: np.ndarray, owner: np.ndarray, some: np.ndarray, own: np.ndarray) -> np.ndarray:
    """128 bits of each line: two of each bin of a signature with ``OWN`` bins of its own, else which of 128 cells its runs fall in.

    Of lines of the second kind ``hashes`` has the runs, and ``owner`` whose they are.  Cells differ in no more places than sets in runs, so what they tell apart does not link for certain.
    """
    cells = np.zeros((len(some), 128), bool)
    cells.reshape(-1)[owner * 128 + (hashes & _U(127)).view(np.int64)] = True
    out = np.packbits(cells, axis=1)
    full = np.flatnonzero(own >= OWN)
    two = (some[full, :SKETCHED] & _U(3)).astype(np.uint8).reshape(len(full), SKETCHED // 4, 4)
    out[full] = (two << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2, dtype=np.uint8)
    return out.view(_U)


def may_link(x: np.ndarray, y: np.ndarray, runs_x: np.ndarray, runs_y: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches may be of lines that link; ``runs`` are negative for sketches of signatures.

    Lines with sketches of different kinds are not told apart.
    """
    z = x ^ y
    apart = np.bitwise_count(z).sum(axis=1)
    unlike = np.bitwise_count((z | (z >> _U(1))) & _U(0x5555555555555555)).sum(axis=1)
    most = (np.abs(runs_x) + np.abs(runs_y)) * (100 - percent) // (100 + percent)
    signed = np.sign(runs_x) + np.sign(runs_y)
    return np.where(signed == 0, True, np.where(signed < 0, unlike <= SKETCHED - AGREE, apart <= most))


def bands(some: np.ndarray) -> np.ndarray:
    """One 64-bit key for each ``BAND`` bins of each signature."""
    parts = some.reshape(len(some), BINS // BAND, BAND)
    key = parts[:, :, 0] * _BAND_FACTORS[0]
    for k in range(1, BAND):
        key += parts[:, :, k] * _BAND_FACTORS[k]
    # one factor for each place, all odd: bands that differ in one bin never have the same sum
    return H.mix(key + np.arange(1, BINS // BAND + 1, dtype=_U) * _TOP)


def _tiny_keys(hashes: np.ndarray, owner: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact keys of the lines ``few``, by line: the sum of the set's hashes, and the sums without one of them."""
    asked = np.zeros(int(owner[-1]) + 1, bool)
    asked[few] = True
    inside = asked[owner]
    of, h = owner[inside], hashes[inside]
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    once = np.concatenate(([True], (of[1:] != of[:-1]) | (h[1:] != h[:-1])))
    of, h = of[once], h[once]
    size = np.bincount(of, minlength=int(few.max()) + 1)
    keep = size[of] <= TINY
    of, h = of[keep], h[keep]
    total = np.zeros(len(size), _U)
    np.add.at(total, of, H.mix(h.copy()))
    lines = np.flatnonzero((size > 0) & (size <= TINY))
    # a set of up to three runs has only itself as a partner
    less = size[of] >= 4
    keys = H.mix(np.concatenate((total[lines], total[of[less]] - H.mix(h[less].copy()))) + _U(99))
    whose = np.concatenate((lines, of[less]))
    order = np.argsort(whose, kind="stable")
    return keys[order], whose[order]


def meeting_keys(lines: list[str], sketched: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys by which the lines meet others, one line after the other, their offsets, and if asked for sketches and numbers of runs (negative: the sketch is of the signature)."""
    m = len(lines)
    some, n = np.full((m, BINS), _EMPTY, _U), np.maximum(np.array([len(x) for x in lines], np.int64) - RUN + 1, 1)
    tiny, whose, held = [], [], []
    for low, high in _slices(lines):
        hashes, owner = _runs(lines[low:high])
        _sign(hashes, owner, some[low:high])
        few = np.flatnonzero(n[low:high] <= 2 * TINY)
        if len(few):
            more, of = _tiny_keys(hashes, owner, few)
            tiny.append(more)
            whose.append(of + low)
        if sketched:
            inside = np.repeat(_own(some[low:high]) < OWN, n[low:high])
            held.append((hashes[inside], owner[inside] + low))
    some, own = _complete(some)
    key, counts = bands(some).ravel(), np.full(m, BINS // BAND)
    if tiny:
        of = np.concatenate((np.repeat(np.arange(m), BINS // BAND), *whose))
        key, counts = np.concatenate((key, *tiny))[np.argsort(of, kind="stable")], np.bincount(of, minlength=m)
    ends = np.concatenate(([0], np.cumsum(counts)))
    if not sketched or not m:
        return key, ends, np.zeros((0, 2), _U), np.zeros(0, np.int64)
    hashes, owner = (np.concatenate(x) for x in zip(*held))
    return key, ends, sketches(hashes, owner, some, own), np.where(own >= OWN, -n, n)


_LINE = "key long, id string, number int, line long, check long, n int, runs int, k0 long, k1 long, keys array<long>"


def _read_lines(marked, bits: int):
    """The lines that come again or share keys, with these keys."""

    @trimmed
    def run(batches):
        for batch in batches:
            key, ids = batch.column("key"), batch.column("id")
            for owner, number, lines in _batches(batch.column("text").to_pylist()):
                h, check = _line_hashes(lines).T.copy()
                again = marks.marked(marked, _short(_line_keys(h), bits).view(np.int64))
                # marked keys and the sketch go with the first of equal lines of a lot
                at = np.sort(np.unique(h, return_index=True)[1])
                keys, ends, sketch, runs = meeting_keys([lines[i] for i in at.tolist()])
                short = _short(keys, bits).view(np.int64)
                keep = marks.marked(marked, short)
                kept = np.concatenate(([0], np.cumsum(keep)))[ends]
                counts, own, sketched = np.zeros(len(lines), np.int64), np.zeros(len(lines), np.int32), np.zeros((len(lines), 2), np.int64)
                met = np.diff(kept) > 0
                counts[at], own[at[met]], sketched[at[met]] = np.diff(kept), runs[met], sketch[met].view(np.int64)
                some = np.flatnonzero(again | (counts > 0))
                offsets = np.concatenate(([0], np.cumsum(counts[some]))).astype(np.int32)
                where = pa.array(owner[some])
                yield pa.RecordBatch.from_arrays([
                    key.take(where), ids.take(where), pa.array(number[some].astype(np.int32)), pa.array(h[some]), pa.array(check[some]), pa.array(np.array([len(lines[i]) for i in some.tolist()], np.int32)),
                    pa.array(own[some]), pa.array(sketched[some, 0]), pa.array(sketched[some, 1]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(short[keep])),
                ], ["key", "id", "number", "line", "check", "n", "runs", "k0", "k1", "keys"])

    return run


def _fetch(bits):
    @trimmed
    def run(batches):
        for pdf in batches:
            for _, _, lines in _batches(pdf["text"].tolist()):
                h = _line_hashes(lines)[:, 0].copy()
                where = np.flatnonzero(marks.marked(bits, h))
                where = where[np.unique(h[where], return_index=True)[1]]
                if len(where):
                    lines = [lines[i] for i in where.tolist()]
                    yield pd.DataFrame({"node": h[where], "n": np.array([max(1, len(x) - RUN + 1) for x in lines], np.int32), "text": lines})

    return run


@trimmed
def _distinct(batches):
    """``n``, the number of runs, becomes that of distinct ones."""
    for pdf in batches:
        yield pd.DataFrame({"node": pdf["node"], "n": np.array([len(s) for s in _sets(pdf["text"].tolist())], np.int32)})


def _sets(lines: list[str]) -> list[np.ndarray]:
    out = []
    for low, high in _slices(lines):
        hashes, owner = _runs(lines[low:high])
        ends = np.searchsorted(owner, np.arange(high - low + 1))
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            hashes[a:b].sort()
        keep = np.ones(len(hashes), bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes = hashes[keep]
        ends = np.searchsorted(owner[keep], np.arange(high - low + 1)).tolist()
        out.extend(hashes[a:b] for a, b in zip(ends[:-1], ends[1:]))
    return out


class _Holders:
    """Which of the lines still waiting hold each token."""

    def __init__(self, token: np.ndarray, owner: np.ndarray, waiting: np.ndarray, n_tokens: int):
        keep = waiting[owner]
        token, owner = token[keep], owner[keep]
        order = np.argsort(token, kind="stable")
        self.lines = owner[order]
        self.first = np.searchsorted(token[order], np.arange(n_tokens + 1))
        self.m, self.held = len(waiting), int(waiting.sum())

    def shared(self, own: np.ndarray) -> np.ndarray:
        """How many of the tokens ``own`` each line holds."""
        counts = self.first[own + 1] - self.first[own]
        at = np.repeat(self.first[own] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return np.bincount(self.lines[at], minlength=self.m)


def forest(token: np.ndarray, owner: np.ndarray, cells: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of sets that link by the exact Jaccard coefficient and between them connect all that link; cells as in :mod:`.blocks`.

    From set to set along links: each that is reached is compared with those not reached yet, so a group
    of near copies costs one comparison with all, not one for each pair.
    """
    m = len(cells)
    if m == 2:  # most blocks
        both = np.sort(token)
        shared = int((both[1:] == both[:-1]).sum())
        return [(0, 1)] if (cells[0] < 0 or cells[0] != cells[1]) and (100 + percent) * shared >= percent * len(token) else []
    sizes, ends = np.bincount(owner, minlength=m), np.searchsorted(owner, np.arange(m + 1))
    distinct, token = np.unique(token, return_inverse=True)
    waiting, left, out = np.ones(m, bool), m, []
    every = holders = None
    if m <= 64:  # all at once
        held = np.zeros((m, len(distinct)), np.float32)
        held[owner, token] = 1
        every = (held @ held.T).astype(np.int64)
    else:
        holders = _Holders(token, owner, waiting, len(distinct))
    for start in range(m):
        if not waiting[start]:
            continue
        waiting[start] = False
        left -= 1
        reached = [start]
        while reached and left:
            i = reached.pop()
            if holders and left < holders.held // 2:
                holders = _Holders(token, owner, waiting, len(distinct))
            shared = holders.shared(token[ends[i] : ends[i + 1]]) if holders else every[i]
            linked = waiting & ((100 + percent) * shared >= percent * (sizes[i] + sizes))
            if cells[i] >= 0:
                linked &= cells != cells[i]
            new = np.flatnonzero(linked).tolist()
            waiting[new] = False
            left -= len(new)
            reached += new
            out += [(i, j) for j in new]
    return out


def _compare(percent: int):
    @trimmed
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block", ignore_index=True)
        nodes, block, cells, lines = pdf["node"].to_numpy(), pdf["block"].to_numpy(), pdf["cell"].to_numpy(), pdf["text"].tolist()
        sets = _sets(lines)
        cuts = np.flatnonzero(np.diff(block)) + 1
        a, b = [], []
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
            some = sets[low:high]
            for i, j in forest(np.concatenate(some), np.repeat(np.arange(high - low), [len(x) for x in some]), cells[low:high], percent):
                a.append(nodes[low + i])
                b.append(nodes[low + j])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits + 40`` bits of keys, by which lines meet."""
    return keys.view(_U) >> _U(24 - bits)


def _line_keys(h: np.ndarray) -> np.ndarray:
    """Keys of the lines themselves, which all that are equal share."""
    return H.mix(h.view(_U) + _U(3))


def _send(bits: int):
    """Keys to their buckets (the first ``bits`` bits), packed, eight bytes each: 40 bits of the key, 24 of who holds it.

    A line holds its ``meeting_keys``, a place in a text the key of its line.
    """

    def packed(keys: list[np.ndarray], holders: list[np.ndarray]):
        short = np.concatenate(keys)
        bucket = (short >> _U(40)).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16), kind="stable") if bits <= 16 else np.argsort(bucket)  # by radix
        low = ((short << _U(24)) | (np.concatenate(holders).view(_U) & _U(0xFFFFFF)))[order]
        bucket = bucket[order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1))
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array([low[a:b].tobytes() for a, b in zip(first, [*first[1:], len(low)])], pa.binary())], ["bucket", "packed"])

    @trimmed
    def run(batches):
        keys, holders, size = [], [], 0
        for batch in batches:
            texts = batch.column("key").to_numpy()
            for owner, number, lines in _batches(batch.column("text").to_pylist()):
                h = _line_hashes(lines)[:, 0].copy()
                at = np.sort(np.unique(h, return_index=True)[1])
                found, ends, _, _ = meeting_keys([lines[i] for i in at.tolist()], sketched=False)
                keys += [_short(found, bits), _short(_line_keys(h), bits)]
                holders += [np.repeat(h[at], np.diff(ends)), H.mix(texts[owner].view(_U) + number.astype(_U)).view(np.int64)]
                size += len(found) + len(h)
                if size >= SENT:
                    yield packed(keys, holders)
                    keys, holders, size = [], [], 0
        if size:
            yield packed(keys, holders)

    return run


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    """Keys of a bucket that several hold, and how many."""
    held = np.frombuffer(b"".join(pdf["packed"]), _U).copy()
    held.sort()
    key = held[np.concatenate(([True], held[1:] != held[:-1]))] >> _U(24)
    first = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
    times = np.diff(first, append=len(key))
    key, times = key[first[times > 1]], times[times > 1]
    return pd.DataFrame({"band": (key | (_U(pdf["bucket"].iloc[0]) << _U(40))).view(np.int64), "times": times})


def shared_keys(docs: DataFrame) -> tuple[DataFrame, int]:
    """Settled ``band, times`` of the keys that several lines of ``docs`` (``key, text``) share, and of lines that come again, and how many bits of them name a bucket.

    Of all keys only eight bytes each travel, to be counted.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(20, max(8, (size // KEY_BYTES // SENT).bit_length()))
    sent = docs.select("key", "text").mapInArrow(_send(bits), "bucket int, packed binary")
    return settle(sent.groupBy("bucket").applyInPandas(_count, "band long, times long"), "shared"), bits


def meetings(keyed: DataFrame, shared: DataFrame) -> DataFrame:
    """Settled ``band, line, runs, k0, k1, times``, one row for each of a line's ``keys``; ``times``, how many lines share it, is there for those too many for one task."""
    rows = keyed.select("line", "runs", "k0", "k1", "keys").dropDuplicates(["line"]).select("line", "runs", "k0", "k1", F.explode("keys").alias("band"))
    hot = shared.where(F.col("times") > MEET)
    hot = F.broadcast(hot) if hot.limit(1 << 16).count() < 1 << 16 else hot  # bounded, or joined by key
    return settle(rows.join(hot, "band", "left"), "met")


def _near(percent: int):
    @trimmed
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of the pairs of a key that may link a forest; cells as in :mod:`.blocks`."""
        pdf = pdf.sort_values(["band", "high", "low", "line"], ignore_index=True)
        line, cell = pdf["line"].to_numpy(), pdf["cell"].to_numpy()
        group = pdf.groupby(["band", "high", "low"], sort=False).ngroup().to_numpy()
        sketch, runs = np.stack((pdf["k0"].to_numpy(), pdf["k1"].to_numpy()), 1).view(_U), pdf["runs"].to_numpy(np.int64)
        nodes, place = np.unique(line, return_inverse=True)
        label = np.arange(len(nodes))
        step, left = 1, np.arange(len(line) - 1)
        while len(left):
            left = left[left + step < len(line)]
            left = left[group[left] == group[left + step]]
            right = left + step
            pick = (line[left] != line[right]) & ((cell[left] < 0) | (cell[left] != cell[right])) & (label[place[left]] != label[place[right]])
            a, b = left[pick], right[pick]
            ok = may_link(sketch[a], sketch[b], runs[a], runs[b], percent)
            label = _united(label, place[a[ok]], place[b[ok]])
            step += 1
        tied = np.flatnonzero(label != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[label[tied]], "b": nodes[tied]})

    return run


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the smallest place of each tree) after ``a`` and ``b`` are connected."""
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        label = label.copy()
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = label[label]
            if np.array_equal(above, label):
                break
            label = above
    return label


def candidate_edges(met: DataFrame, percent: int) -> DataFrame:
    """``a, b``: lines that meet and may link, or a tree that connects them.  A key of very many rows is cut into cells, each pair of which is a task."""
    cells = F.ceil(F.coalesce("times", F.lit(1)) / MEET).cast("int")
    own = met.withColumn("cells", cells).withColumn("own", F.pmod(F.xxhash64("line"), F.col("cells")).cast("int"))
    dealt = F.transform(F.sequence(F.lit(0), F.col("cells") - 1), lambda k: F.struct(
        F.least("own", k).alias("low"), F.greatest("own", k).alias("high"), F.when(k == F.col("own"), -1).when(F.col("own") < k, 0).otherwise(1).alias("cell")))
    held = ["band", "line", "runs", "k0", "k1"]
    tasks = max(1, -(-met.count() // MEET_ROWS))
    # most keys have one cell, and need no list of pairs
    few = own.where(F.col("times").isNull() | (F.col("times") <= MEET)).select(*held, F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(-1).alias("cell"))
    rows = few.unionByName(own.where(F.col("times") > MEET).select(*held, F.inline(dealt)))
    rows = rows.withColumn("task", F.when(F.col("high") > 0, F.xxhash64("band", "low", "high")).otherwise(F.pmod(F.xxhash64("band"), F.lit(tasks))))
    return rows.groupBy("task").applyInPandas(_near(percent), "a long, b long").distinct()


def line_links(docs: DataFrame, met: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``a, b`` between the lines of ``docs`` that meet (:func:`meetings`); between them they connect all that link."""
    blocks = settle(components(candidate_edges(met, percent)).select("node", F.col("component").alias("block")), "blocks")
    bits = marks.bitmap(blocks.select(F.col("node").alias("key")))
    sets = docs.select("text").mapInPandas(_fetch(bits), "node long, n int, text string")
    sets = settle(sets.join(blocks, "node").dropDuplicates(["node"]), "sets")
    # blocks that don't fit a task are left for the keys that made them
    too_large = settle(sets.groupBy("block").agg(F.sum("n").alias("runs")).where(F.col("runs") > TASK_RUNS).select("block"), "large")
    members = sets.select("node", "block", "n")
    if not too_large.isEmpty():
        # cells of large blocks go by sizes of sets
        large = sets.join(too_large, "block", "left_semi").select("node", "text").mapInPandas(_distinct, "node long, n int")
        by_key = met.select("band", F.col("line").alias("node")).join(large, "node").select("node", F.col("band").alias("block"), "n").distinct()
        members = members.join(too_large, "block", "left_anti").unionByName(by_key)
    tasks = block_tasks(settle(members.withColumn("weight", F.col("n").cast("long")), "members"), percent / 100, TASK_RUNS)
    return tasks.join(sets.select("node", "text"), "node").groupBy("task").applyInPandas(_compare(percent), "a long, b long")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("string").alias("id"), "text")


def removed_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``key, id, numbers`` for every text that loses lines: their numbers from 0; ``key`` is xxhash64 of id and text, ``id`` the id as text."""
    ship(docs.sparkSession)
    own_type = docs.schema["doc_id"].dataType
    rows = _rows(docs)
    with Tables() as work:
        shared, bits = shared_keys(rows)
        marked = marks.bitmap(shared.select(F.col("band").alias("key")))
    seen = settle(rows.mapInArrow(_read_lines(marked, bits), _LINE), "lines")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").cast(own_type).alias("doc_id"), "id", "key", "number")
    same = ["line", "check", "n"]
    with work:
        linked = line_links(rows, meetings(seen.where(F.size("keys") > 0), shared), percent)
    united = components(linked).select(F.col("node").alias("line"), F.col("component").alias("root"))
    work.drop()
    lines = seen.groupBy(*same).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    # lines that occur once and link with nothing need no decision
    classes = settle(lines.join(united, "line", "left").where("root is not null or times > 1").withColumn("root", F.coalesce("root", F.xxhash64(*same))), "classes")
    kept = classes.groupBy("root").agg(F.min("first").alias("kept"))
    decided = classes.join(kept, "root").select(*same, "kept")
    gone = seen.select("key", "id", "number", *same).join(decided, same).where("key != kept.key or number != kept.number or not id <=> kept.id")
    return gone.groupBy("key", "id").agg(F.collect_set("number").alias("numbers"))


def _place(id_: Column) -> Column:
    """The id as text that is not null, another one for each."""
    return F.coalesce(F.concat(F.lit("i"), id_), F.lit(""))


def rewrite(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``text`` without the removed lines, ``n_lines`` and ``n_removed``.

    Equal rows (id and text) are one; texts that lost every line that is not blank are there, empty.
    """
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).withColumn("key", F.xxhash64("row.doc_id", "row.text"))
    keyed = keyed.withColumn("place", _place(F.col("row.doc_id").cast("string")))
    first = F.row_number().over(Window.partitionBy("key", "place").orderBy(F.xxhash64("row")))
    once = keyed.withColumn("copy", first).where("copy = 1").select("row", "key", "place")
    # window and join deal rows by the same columns, so that texts are shuffled and sorted for both at once
    once = once.join(removed.select("key", _place(F.col("id")).alias("place"), "numbers"), ["key", "place"], "left")
    once = once.select("row", "numbers", F.split("row.text", "\n").alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "numbers")
    text = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    filled = F.size(F.filter("lines", lambda x: F.ltrim(x, F.lit(BLANK)) != ""))
    counted = once.select("row", text.alias("left"), F.when(F.col("row.text").isNull(), 0).otherwise(filled).alias("n_lines"), F.coalesce(F.size("numbers"), F.lit(0)).alias("n_removed"))
    whole = (F.col("n_removed") > 0) & (F.col("n_removed") >= F.col("n_lines"))
    return counted.select("row", F.when(whole, "").when(F.col("n_removed") > 0, F.col("left")).otherwise(F.col("row.text")).alias("text"), "n_lines", "n_removed")


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one line of each component left, without documents that lost all lines."""
    out = rewrite(docs, removed_lines(docs, percent)).where("n_removed = 0 or n_removed < n_lines")
    return out.select(*[out["text"] if c == "text" else out["row"].getField(c).alias(c) for c in docs.columns])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy line dedup of all documents: ``doc_id, n_lines, n_removed, kept_sha256``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rewrite(docs, removed_lines(docs)).select(
        "row.doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


QUERIES = {"op9_line_dedup": op9_line_dedup}
SQL: dict[str, str] = {}
