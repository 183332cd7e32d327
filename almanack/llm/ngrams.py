"""Operator 2: n-gram Jaccard join with a prefix tree.

Method: a document's set is its distinct word n-grams.  The sets of a block are
stored, in one global order of n-grams (that of their hashes), in a prefix tree (:mod:`.trie`), which is
traversed once per set, sharing partial overlaps and pruning subtrees by
remaining length.  The links found are exact and connect all that link.

Blocks keep apart what cannot link.  Two sets that reach the threshold differ
in at most d n-grams, so if the hash space is cut into d + 2 parts, two parts
hold the same n-grams in both; the hash of a part's n-grams is a sign, and sets
that share two are candidates.  The number of parts goes by size: sizes are
cut into intervals so that partners lie in equal or adjacent ones, and a set gives its
signs for its own interval and the next.  Signs travel packed, and what meets by signs is tested by
sketches (:mod:`.signs`), so a passage that many documents share makes few candidates.  Components
of the candidate graph are the blocks.

Equal sets are one class throughout, so a group of copies costs one set.
Texts travel once, and only those of classes with candidates are turned into
sets again.  Blocks of any size are cut into bounded tasks (:mod:`.blocks`).

Null or empty texts have no n-grams and link with nothing, not with each other;
a text of fewer words than ``n`` has its whole sequence as one n-gram; very long texts are read whole.  Rows may
repeat: equal rows are copies, and :func:`first_of_each` leaves one, of those that differ in other columns
the first by hash of the row.  Ids keep their type.  Rows with null ids count in links, and the
smallest id of a component is that of the others, null if there is none.
Empty tables give no rows; extra columns are not read, and pass :func:`first_of_each` whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing as H
from . import marks, trie
from . import signs as met
from .blocks import block_tasks
from .common import components, settle, ship, table
from .memory import trimmed

N = 4
PERCENT = 85
#: n-grams that a cell of a task holds at most (but for a single set that is larger).
TASK_GRAMS = 1 << 20


def grams(texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text and their offsets; a text of 1 to n - 1 words has one."""
    words, offsets = H.words(texts, fold=True)
    counts = np.diff(offsets)
    at, owner = H.window_index(offsets, n)
    hashes = H.windows(words, n)[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.array([H.windows(words[a : a + c], int(c))[0] for a, c in zip(offsets[short], counts[short])], np.uint64)
        hashes = np.concatenate((hashes, H.mix(whole + counts[short].astype(np.uint64))))
        owner = np.concatenate((owner, short))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[keep], owner[keep]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


def intervals(longest: int, percent: int) -> np.ndarray:
    """Upper ends of the size intervals up to one past that of ``longest``; the first is 0."""
    ends = [0, 1]
    while ends[-2] < longest:
        ends.append((ends[-1] + 1) * 100 // percent)
    ends.append((ends[-1] + 1) * 100 // percent)
    return np.array(ends)


def part_counts(ends: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For each size interval: the number of parts, and how many of them may be empty.

    The sets of an interval and the one before it that reach the threshold
    differ in so many n-grams at most; there are two parts more, and beyond those as
    many as are empty by chance in the smallest such set, and a quarter more.
    """
    # two more than they differ in: partners share two signs
    apart = 2 * ends * (100 - percent) // (100 + percent) + 1
    least = np.concatenate(([0, 0], ends[:-2])) + 1
    spare = np.full(len(ends), 4)
    for _ in range(12):
        parts = apart + 1 + spare
        spare = 4 + (1.25 * parts * np.exp(-least / parts)).astype(np.int64)
    return apart + 1 + spare, spare


def signs(hashes: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signs of all sets, one after the other, and their offsets.  Empty sets have none."""
    sizes = np.diff(offsets)
    ends = intervals(int(sizes.max(initial=1)), percent)
    of_interval, allowed = part_counts(ends, percent)
    own = np.searchsorted(ends, sizes)
    mixed = H.mix(hashes)
    high = hashes >> np.uint64(32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out, of = [], []
    for interval in (own, own + 1):
        interval = np.minimum(interval, len(ends) - 1)
        parts, spare = np.where(sizes > 0, of_interval[interval], 0), allowed[interval]
        base = np.cumsum(parts) - parts
        at = base[owner] + ((high * parts[owner].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        total = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(total, at, mixed)
        empty = np.bincount(at, minlength=len(total)) == 0
        whose = np.repeat(np.arange(len(sizes)), parts)
        number = (np.arange(len(total)) - base[whose]).astype(np.uint64)
        sign = H.mix(total + H.mix((interval[whose].astype(np.uint64) << np.uint64(40)) + number + np.uint64(1)))
        many = np.bincount(whose[empty], minlength=len(sizes)) > spare
        keep = ~empty | many[whose]
        out.append(sign[keep])
        of.append(whose[keep])
    whose = np.concatenate(of)
    order = np.argsort(whose, kind="stable")
    return np.concatenate(out)[order], np.searchsorted(whose[order], np.arange(len(sizes) + 1))


#: ``ref`` numbers the rows, those of a task one after the other.
_SET = "ref long, key long, doc_id string, n int, k1 long, k2 long, sketch binary, signs binary"


def _describe(n: int, percent: int):
    @trimmed
    def run(batches):
        ref = TaskContext.get().partitionId() << 40
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                hashes, offsets = grams(part["text"].tolist(), n)
                sums = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    total = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(H.mix(hashes * np.uint64(salt) + np.uint64(salt >> 7)), out=total[1:])
                    sums.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
                sign, ends = signs(hashes, offsets, percent)
                sign = met.short(sign)
                yield pd.DataFrame({"ref": np.arange(ref, ref + len(part)), "key": part["key"].to_numpy(), "doc_id": part["doc_id"].to_numpy(object), "n": np.diff(offsets).astype(np.int32),
                                    "k1": sums[0], "k2": sums[1], "sketch": met.sketches(hashes, offsets), "signs": [sign[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]})
                ref += len(part)

    return run


def _pick(bits):
    @trimmed
    def run(batches):
        for pdf in batches:
            yield pdf[marks.marked(bits, pdf["key"].to_numpy())]

    return run


def _join(n: int, percent: int):
    @trimmed
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, block in pdf.groupby("block", sort=False):
            nodes = block["node"].to_numpy()
            hashes, offsets = grams(block["text"].tolist(), n)
            for i, j in trie.links(np.split(hashes, offsets[1:-1]), block["cell"].to_numpy(), percent):
                a.append(nodes[i])
                b.append(nodes[j])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def link_components(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``key, doc_id, n_shingles, component_id``; ``key`` is xxhash64 of id and text."""
    ship(docs.sparkSession)
    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    sets = settle(rows.mapInPandas(_describe(n, percent), _SET).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)), "sets")
    classes = sets.where("n > 0").groupBy("k1", "k2", "n").agg(F.min(F.struct("key", "ref")).alias("one"), F.min("doc_id").alias("first_doc"))
    classes = settle(classes.select("k1", "k2", "n", F.col("one.key").alias("cls"), F.col("one.ref").alias("ref"), "first_doc"), "classes")
    blocks = components(met.candidate_edges(sets, classes, percent)).select(F.col("node").alias("ref"), F.col("component").alias("block"))
    members = classes.join(blocks, "ref").select(F.col("cls").alias("node"), "block", "n", F.col("n").cast("long").alias("weight"))
    members = settle(members, "members")
    tasks = block_tasks(members, percent / 100, TASK_GRAMS)
    # only texts of candidates leave the scan
    bits = marks.bitmap(members.select(F.col("node").alias("key")))
    texts = rows.select("key", "text").mapInPandas(_pick(bits), "key long, text string").join(members.select(F.col("node").alias("key")), "key", "left_semi")
    texts = texts.dropDuplicates(["key"]).withColumnRenamed("key", "node")
    found = tasks.join(texts, "node").groupBy("task").applyInPandas(_join(n, percent), "a long, b long")
    linked = components(found).select(F.col("node").alias("cls"), F.col("component").alias("root"))
    rooted = classes.join(linked, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    lowest = rooted.groupBy("root").agg(F.min("first_doc").alias("lowest"))
    labels = rooted.join(lowest, "root").select("k1", "k2", "n", "lowest")
    return sets.drop("ref", "sketch", "signs").join(labels, ["k1", "k2", "n"], "left").select("key", "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("lowest", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` without near duplicates, all columns: one row of each component stays, the one of the smallest id.

    Of equal rows with that id one stays.  Empty texts are never duplicates.  A row is known by its
    id and the hash of id and text, so no collision of hashes can remove a row of another id.
    """
    labels = link_components(docs, n, percent)
    first = F.min_by(F.struct("key", "doc_id"), F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    ranked = labels.where("n_shingles > 0").groupBy("component_id").agg(first.alias("first")).select(F.col("first.key").alias("k"), F.col("first.doc_id").alias("i"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").alias("id"))
    empty = ~F.coalesce(F.col("row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = rows.where(~empty).join(ranked, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
    copy = F.row_number().over(Window.partitionBy("key", "id").orderBy(F.xxhash64("row")))
    once = kept.withColumn("copy", copy).where("copy = 1").select("row").unionByName(rows.where(empty).select("row"))
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links all documents by 4-word shingles at a Jaccard coefficient of 0.85."""
    return link_components(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op2_ngram_jaccard_join": op2_ngram_jaccard_join}
SQL: dict[str, str] = {}
