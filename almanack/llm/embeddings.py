"""Operator 7: embedding near-dedup over HNSW graphs.

Method: vectors are dealt to shards by hash, each shard builds a hierarchical
navigable small-world graph (:mod:`.hnsw`), and every vector queries every
shard, in blocks as large as a shard, so that a graph travels once per block.
The beam of a block is widened until two audits pass: brute
force over the shard for some of the block's queries, and vectors of the shard
moved to just above the threshold, which must be found again; recall is judged by
query, so a large cluster can't hide what others miss.  The widest beam
is the whole shard, read by matrix products: a query whose beam is full
of links goes there at once, and a whole block does whose audits don't
pass while a graph is the cheaper way.  Each link found is verified by the cosine in
double precision.

Equal vectors are one class: copies cost one query.  A task returns counts, and
of the links a forest that connects the same vectors; components are united by
star contraction in Spark.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; vectors of different lengths do not link.  Rows with equal
``vec_id`` are vectors of their own and share the id in the result; a null ``vec_id`` counts
in links, and its component has the smallest id that is not null.  An empty table gives
no rows; other columns, ``label`` too, are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hnsw
from .common import components, settle, ship, table
from .memory import trimmed

THRESHOLD = 0.95
#: Vectors of a shard, and queries of a block, at most on average.
SHARD = 1 << 16
BLOCK = 1 << 16
MIN_SHARDS = 4
FIRST_BEAM = 32
#: A beam of this part of a shard costs more than a matrix product with all of it.
WIDEST = 64
#: Queries whose cosines with a whole shard are held at once.
PRODUCT = 64
RECALL = 0.99
AUDITS = 64
#: Links, its own included, up to which an audited query counts with those of few.
FEW = 8


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@trimmed
def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node")
    raw = np.stack(pdf["vector"].to_list())
    graph = hnsw.Graph(_unit(raw.astype(np.float64)))
    packed = pickle.dumps((raw[graph.order], graph.layers, pdf["node"].to_numpy()[graph.order], pdf["copies"].to_numpy()[graph.order]))
    return pd.DataFrame({"dim": pdf["dim"][:1], "shard": pdf["shard"][:1], "graph": [packed]})


def _whole(exact, queries, threshold: float) -> list[np.ndarray]:
    """For each query the places of its links, by the cosines with all vectors of the shard."""
    out: list = []
    for at in range(0, len(queries), PRODUCT):
        linked = queries[at : at + PRODUCT] @ exact.T >= threshold
        out.extend(np.flatnonzero(row) for row in linked)
    return out


def _found(graph, exact, queries, beam: int, threshold: float) -> list[np.ndarray]:
    """For each query the places of its links; where the beam is full of them, the whole shard is read."""
    if beam >= len(exact):
        return _whole(exact, queries, threshold)
    out: list = [None] * len(queries)
    ids, sims = graph.search(queries, beam)
    full = sims[:, -1] >= threshold - 1e-4
    near = (ids >= 0) & (sims >= threshold - 1e-4)
    for row in np.flatnonzero(~full).tolist():
        some = ids[row][near[row]]
        out[row] = some[exact[some] @ queries[row] >= threshold] if len(some) else some
    for row, some in zip(np.flatnonzero(full).tolist(), _whole(exact, queries[full], threshold)):
        out[row] = some
    return out


class Forest:
    """Of links among ``n`` places those that connect what was not connected before."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def _roots(self, places: np.ndarray) -> np.ndarray:
        found = self.parent[places]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                return found
            found = above

    def join(self, place: int, others: np.ndarray) -> np.ndarray:
        """Connects ``place`` with ``others`` and returns one of these for each tree that was not its own."""
        every = np.append(others, place)
        root = self._roots(every)
        trees, first = np.unique(root, return_index=True)
        new = every[first[trees != root[-1]]]
        self.parent[trees] = trees[0]
        self.parent[every] = trees[0]
        return new


def audited_beam(graph, exact, queries, threshold: float) -> int:
    """The narrowest beam, by doubling, that finds ``RECALL`` of what brute force finds; else the whole shard.

    Recall is the mean over queries, so that those in a cluster don't speak for the
    others: it must be reached by the moved vectors, by queries with few links, and by the rest.
    """
    rng = np.random.default_rng(11)
    some = exact[rng.choice(len(exact), min(AUDITS, len(exact)), replace=False)]
    noise = rng.standard_normal(some.shape)
    noise -= (noise * some).sum(1, keepdims=True) * some
    near = threshold + (1 - threshold) / 8
    size = np.sqrt((noise * noise).sum(1, keepdims=True))
    moved = some * near + np.divide(noise, size, out=np.zeros_like(noise), where=size > 1e-9) * np.sqrt(1 - near * near)
    asked = np.concatenate((queries[rng.choice(len(queries), min(AUDITS, len(queries)), replace=False)], moved))
    real = (asked @ exact.T >= threshold).sum(axis=1)
    is_moved = np.arange(len(asked)) >= len(asked) - len(moved)
    groups = [g & (real > 0) for g in (is_moved, ~is_moved & (real <= FEW), ~is_moved & (real > FEW))]
    groups = [g for g in groups if g.any()]
    beam = FIRST_BEAM
    while beam <= max(FIRST_BEAM, len(exact) // WIDEST):
        hits = np.array([len(x) for x in _found(graph, exact, asked, beam, threshold)])
        if all(np.mean(hits[g] / real[g]) >= RECALL for g in groups):
            return beam
        beam *= 2
    return len(exact)


def _query(threshold: float):
    @trimmed
    def run(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        a, n, b = [], [], []
        if len(index) and len(asked):
            raw, layers, nodes, copies = pickle.loads(index["graph"].iloc[0])
            exact = _unit(raw.astype(np.float64))
            graph = hnsw.Graph.restored(exact, layers)
            queries = _unit(_matrix(asked["vector"]))
            own = asked["node"].to_numpy()
            beam = audited_beam(graph, exact, queries, threshold)
            # places of the shard, then queries that are not in it
            order = np.argsort(nodes)
            at = order[np.minimum(np.searchsorted(nodes, own, sorter=order), len(nodes) - 1)]
            place = np.where(nodes[at] == own, at, len(nodes) + np.arange(len(own)))
            forest = Forest(len(nodes) + len(own))
            for low in range(0, len(queries), 256):
                for i, near in enumerate(_found(graph, exact, queries[low : low + 256], beam, threshold), low):
                    other = near[near != place[i]]
                    if not len(other):
                        continue
                    a.append(own[i])
                    n.append(int(copies[other].sum()))
                    b.append(None)
                    for x in nodes[forest.join(int(place[i]), other)].tolist():
                        a.append(own[i])
                        n.append(0)
                        b.append(x)
        return pd.DataFrame({"a": np.array(a, np.int64), "n": np.array(n, np.int64), "b": pd.array(b, "Int64")})

    return run


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``rows`` (``vec_id, embedding``)."""
    ship(rows.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    sound = F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    sound = sound & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(vector, lambda x: x != 0)
    every = rows.select("vec_id", "embedding", F.coalesce(sound, F.lit(False)).alias("sound"))
    every = every.select("vec_id", "sound", F.when(F.col("sound"), F.transform("embedding", lambda x: x + F.lit(0).cast("float"))).alias("embedding")) if dict(rows.dtypes)["embedding"] == "array<float>" else every
    every = settle(every.withColumn("hash", F.when(F.col("sound"), F.xxhash64("embedding"))), "vectors")
    classes = every.where("sound").groupBy("hash", "embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    sizes = {r["dim"]: r["n"] for r in classes.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = max(sizes.values(), default=0)
    shards, blocks = max(MIN_SHARDS, -(-n // SHARD)), max(1, -(-n // BLOCK))
    placed = classes.select("node", "copies", F.size("embedding").alias("dim"), F.col("embedding").alias("vector"),
                            F.pmod("hash", F.lit(shards)).cast("int").alias("shard"), F.pmod(F.xxhash64("hash"), F.lit(blocks)).cast("int").alias("block"))
    graphs = settle(placed.drop("block").groupBy("dim", "shard").applyInPandas(_build, "dim int, shard int, graph binary"), "graphs")
    # a graph is sent once per block, and a block is as large as a shard
    index = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = placed.select("node", "dim", "vector", "block").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ["dim", "shard", "block"]
    found = settle(index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_query(threshold), "a long, n long, b long"), "found")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    linked = components(found.where("b is not null").select("a", "b"))
    rooted = classes.select("node", "hash", "embedding", "first", "copies").join(linked, "node", "left").join(counts, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "node"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    labels = rooted.join(lowest, "root").select("hash", "embedding", "lowest", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = every.join(labels, ["hash", "embedding"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("lowest", "vec_id").alias("component_id"),
                      F.coalesce(F.coalesce("lowest", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links all embeddings at a cosine of 0.95."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {"op7_embedding_near_dedup": op7_embedding_near_dedup}
SQL: dict[str, str] = {}
