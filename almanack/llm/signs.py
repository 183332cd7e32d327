"""Finds the classes that share signs, without a row per sign.

A sign travels as eight bytes: 48 of its bits and, in 16 more, which row of a
stretch of numbered rows it belongs to.  So a sign costs the same whatever the number
of partitions it is dealt to (a row of Spark's for each sign is compressed less and less the
more there are).  Signs are dealt by their first bits to buckets of bounded size, in which equal ones
meet by sorting.  Signs that agree in 48 bits by chance only add candidates.

Sharing signs is not enough to make two classes candidates where many do: a
passage that many documents hold fills whole parts of short ones, and the more documents there are, the more
of them share such parts, until chance meetings tie nearly all short documents into one
block.  So every meeting is tested by sketches.  The sketch of a set has, for each of K
cells that the hashes of its n-grams fall into, the parity of their number; the
sketches of two sets differ in no more bits than the sets differ in n-grams, so no link is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import marks
from .common import settle
from .memory import trimmed

_U = np.uint64
#: Rows of a stretch, signs that a task packs at once, and signs of a bucket (more buckets at least than partitions).
STRETCH, LOT, BUCKET = 1 << 16, 1 << 20, 1 << 19
#: Classes of a sign among which pairs are counted: a pair must be seen twice, as partners share two signs.
FEW = 8
#: Classes of a sign beyond which they are one candidate block without a test.
CROWD = 1 << 15
#: Rows of a task that tests meetings, and words of sketches that it compares at once.
TESTED, WORDS = 1 << 15, 1 << 20
LEAST_CELLS, MOST_CELLS = 64, 4096


def short(signs: np.ndarray) -> np.ndarray:
    """The six bytes of each sign that are kept, one sign after the other."""
    return np.ascontiguousarray(signs.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _long(packed: list[bytes]) -> np.ndarray:
    six = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel()


def sketches(hashes: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Parities of the cells of each set; there are as many cells as n-grams, as a power of two within bounds."""
    sizes = np.diff(offsets)
    cells = np.clip(1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), LEAST_CELLS, MOST_CELLS)
    base = np.cumsum(cells) - cells
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = base[owner] + (hashes & (cells[owner] - 1).astype(_U)).astype(np.int64)
    odd = np.packbits(np.bincount(at, minlength=int(cells.sum())).astype(np.uint8) & 1, bitorder="little").tobytes()
    return [odd[a : a + c] for a, c in zip((base // 8).tolist(), (cells // 8).tolist())]


def _folded(held: np.ndarray, cells: int) -> np.ndarray:
    """Sketches of ``cells`` cells or more as words of such of ``cells`` cells."""
    lengths = np.array([len(s) for s in held])
    out = np.empty((len(held), cells // 64), _U)
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        words = np.frombuffer(b"".join(held[at]), _U).reshape(len(at), -1, cells // 64)
        out[at] = np.bitwise_xor.reduce(words, axis=1)
    return out


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _may_link(n_a: np.ndarray, n_b: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    return ((100 + percent) * differ <= (100 - percent) * (n_a + n_b)) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


def _deal(bits, buckets: int):
    @trimmed
    def run(batches):
        refs, signs, counts = [], [], []

        def out():
            if not refs:
                return
            sign, ref = _long(signs), np.array(refs, np.int64)
            packed = (sign << _U(16)) | np.repeat((ref - ref[0]).astype(_U), counts)
            packed.sort()
            ends = np.searchsorted(packed >> _U(32), (np.arange(1, buckets, dtype=np.int64) << 32) // buckets)
            parts = np.split(packed, ends)
            some = [i for i, p in enumerate(parts) if len(p)]
            yield pd.DataFrame({"bucket": np.array(some, np.int32), "base": np.full(len(some), ref[0]), "signs": [parts[i].tobytes() for i in some]})

        held = 0
        for pdf in batches:
            pdf = pdf[marks.marked(bits, pdf["ref"].to_numpy())]
            for ref, sign in zip(pdf["ref"].tolist(), pdf["signs"]):
                if refs and (held >= LOT or not refs[0] <= ref < refs[0] + STRETCH):
                    yield from out()
                    refs, signs, counts, held = [], [], [], 0
                refs.append(ref)
                signs.append(sign)
                counts.append(len(sign) // 6)
                held += counts[-1]
        yield from out()

    return run


@trimmed
def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of the signs of a bucket: pairs ``a, b`` that share one of few classes (kind 0) or one of a crowd (2), and ``sign, a`` of the others (1)."""
    packed = [np.frombuffer(s, _U) for s in pdf["signs"]]
    ref = np.concatenate([b + (p & _U(STRETCH - 1)).astype(np.int64) for b, p in zip(pdf["base"], packed)])
    sign = np.concatenate(packed) >> _U(16)
    order = np.argsort(sign, kind="stable")
    sign, ref = sign[order], ref[order]
    first = np.flatnonzero(np.concatenate(([True], sign[1:] != sign[:-1])))
    members = np.diff(np.concatenate((first, [len(sign)])))
    several = np.repeat(members > 1, members)
    sign, ref = sign[several], ref[several]
    members = np.repeat(members[members > 1], members[members > 1])
    kinds, ids, a, b = [], [], [], []

    def add(kind: int, at: np.ndarray, other: np.ndarray) -> None:
        kinds.append(np.full(len(at), kind, np.int32))
        ids.append(sign[at].astype(np.int64))
        a.append(np.minimum(ref[at], ref[other]))
        b.append(np.maximum(ref[at], ref[other]))

    for k in range(1, FEW):
        at = np.flatnonzero((sign[k:] == sign[:-k]) & (members[k:] <= FEW) & (ref[k:] != ref[:-k]))
        add(0, at, at + k)
    at = np.flatnonzero((members > FEW) & (members <= CROWD))
    add(1, at, at)
    at = np.flatnonzero((sign[1:] == sign[:-1]) & (members[1:] > CROWD))
    add(2, at, at + 1)
    return pd.DataFrame({"kind": np.concatenate(kinds), "sign": np.concatenate(ids), "a": np.concatenate(a), "b": np.concatenate(b)})


def tied(n: np.ndarray, words: np.ndarray, label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs that pass the test and, with what ``label`` ties already, connect all that pass it."""
    top = list(range(int(label.max()) + 1))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    live = np.arange(len(n))
    while True:
        of = np.array([root(x) for x in range(len(top))])[label]
        known, size = np.unique(of[live], return_counts=True)
        if len(known) < 2:
            return out
        # all but the largest are compared with all others, and need not be again
        some = live[of[live] != known[size.argmax()]][: max(1, WORDS // (len(live) * words.shape[1]))]
        ok = _may_link(n[some][:, None], n[live], _differ(words[some][:, None], words[live]), percent) & (of[some][:, None] != of[live])
        i, j = np.nonzero(ok)
        if len(i):
            _, one = np.unique(of[some[i]] * len(top) + of[live[j]], return_index=True)
            for x, y in zip(some[i[one]].tolist(), live[j[one]].tolist()):
                u, v = root(int(label[x])), root(int(label[y]))
                if u != v:
                    top[max(u, v)] = min(u, v)
                    out.append((x, y))
        live = live[~np.isin(live, some, assume_unique=True)]


def _test(percent: int):
    @trimmed
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["group", "n", "ref"])
        group, ref, n, held = pdf["group"].to_numpy(), pdf["ref"].to_numpy(), pdf["n"].to_numpy(np.int64), pdf["sketch"].to_numpy(object)
        # neighbours in order of size first: that settles pairs, and most of what belongs together
        cells = 8 * np.array([len(s) for s in held], np.int64)
        least = np.minimum(cells[1:], cells[:-1])
        same = group[1:] == group[:-1]
        ties = np.zeros(max(0, len(group) - 1), bool)
        for c in np.unique(least[same]):
            every = np.flatnonzero(same & (least == c))
            for k in range(0, len(every), WORDS * 64 // int(c)):
                at = every[k : k + WORDS * 64 // int(c)]
                ties[at] = _may_link(n[at], n[at + 1], _differ(_folded(held[at], int(c)), _folded(held[at + 1], int(c))), percent)
        a, b = [ref[:-1][ties]], [ref[1:][ties]]
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        for low, high in zip(first.tolist(), [*first[1:].tolist(), len(group)]):
            between = ties[low : high - 1]
            if high - low > 2 and not between.all():
                pairs = tied(n[low:high], _folded(held[low:high], int(cells[low:high].min())), np.concatenate(([0], np.cumsum(~between))), percent)
                at = np.array(pairs, np.int64).reshape(-1, 2) + low
                a.append(ref[at[:, 0]])
                b.append(ref[at[:, 1]])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return run


def candidate_edges(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between classes that connect all that may reach the threshold by signs, sizes and sketches.

    ``sets`` (``ref, n, sketch, signs``) is a settled table, of which the rows whose ``ref`` is in ``classes`` count; copies of
    them may pass too.  Partners share two signs.  Where at most ``FEW`` classes share a sign, pairs are counted, must be
    seen twice and are tested.  The classes of a larger group are tested at once, until all that pass are connected; a group of more than ``CROWD``
    is connected as it is, which costs time in its block but loses no link.
    """
    spark = sets.sparkSession
    bits = marks.bitmap(classes.select(F.col("ref").alias("key")))
    total = sets.agg(F.sum(F.length("signs"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 6 // BUCKET + 1)
    dealt = sets.where("n > 0").select("ref", "signs").mapInPandas(_deal(bits, buckets), "bucket int, base long, signs binary")
    met = settle(dealt.groupBy("bucket").applyInPandas(_meet, "kind int, sign long, a long, b long"), "met")
    twice = met.where("kind = 0").groupBy("a", "b").count().where("count > 1").select(F.xxhash64("a", "b").alias("group"), F.explode(F.array("a", "b")).alias("ref"))
    rows = twice.unionByName(met.where("kind = 1").select(F.col("sign").alias("group"), F.col("a").alias("ref")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), met.where("kind < 2").count() // TESTED)
    rows = rows.join(sets.select("ref", "n", "sketch"), "ref").withColumn("task", F.pmod(F.xxhash64("group"), F.lit(tasks)))
    return rows.groupBy("task").applyInPandas(_test(percent), "a long, b long").unionByName(met.where("kind = 2").select("a", "b"))
