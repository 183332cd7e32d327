"""A hierarchical navigable small-world graph over unit vectors, for many queries at a time.

Insertion and search move a whole batch of queries through a layer together, so
the inner loops are array operations.  Similarity is the dot product.
"""

from __future__ import annotations

import numpy as np

M = 12
M0 = 24
BUILD_BEAM = 64
#: Beam places expanded per round, for each query.
STEP = 4


def _sims(vectors: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.einsum("qd,qnd->qn", queries, vectors[ids], optimize=False)


def beam_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: none) and similarities of the ``beam`` best found for each query, best first.

    ``links[i]`` are the neighbours of ``i``, -1 for none; ``entry`` gives each query some starting ids, -1 for none.
    """
    n, q = len(vectors), len(queries)
    rows = np.arange(q)[:, None]
    seen = np.zeros((q, n + 1), bool)  # the last column stands for id -1
    seen[:, n] = True
    ids = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -2.0, np.float32)
    fresh = np.zeros((q, beam), bool)
    new = entry[:, :beam]
    ids[:, : new.shape[1]] = new
    sims[:, : new.shape[1]] = np.where(new >= 0, _sims(vectors, queries, new), -2)
    fresh[:, : new.shape[1]] = new >= 0
    seen[rows, new] = True
    seen[:, n] = True
    live = np.arange(q)
    while len(live):
        rank = np.where(fresh[live], sims[live], -9)
        top = np.argpartition(-rank, min(STEP, beam) - 1, axis=1)[:, :STEP]
        at = live[:, None]
        chosen = np.where(fresh[at, top], ids[at, top], -1)
        fresh[at, top] = False
        near = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(live), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near = np.where(seen[at, near], -1, near)
        seen[at, near] = True
        seen[:, n] = True
        got = np.where(near >= 0, _sims(vectors, queries[live], near), -2).astype(np.float32)
        all_ids = np.concatenate((ids[live], near), axis=1)
        all_sims = np.concatenate((sims[live], got), axis=1)
        all_fresh = np.concatenate((fresh[live], near >= 0), axis=1)
        best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        here = np.arange(len(live))[:, None]
        ids[live], sims[live], fresh[live] = all_ids[here, best], all_sims[here, best], all_fresh[here, best]
        live = live[fresh[live].any(axis=1)]
    order = np.argsort(-sims, axis=1, kind="stable")
    return ids[rows, order], sims[rows, order]


def _diverse(vectors: np.ndarray, own: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of candidates, best first, those nearer to the point than to any one taken before; then the best left, up to ``most``."""
    q, c = ids.shape
    v = vectors[ids]
    between = np.einsum("qad,qbd->qab", v, v, optimize=True)
    taken = np.zeros((q, c), bool)
    for k in range(c):
        ok = (ids[:, k] >= 0) & (ids[:, k] != own) & (taken.sum(1) < most)
        ok &= ~((between[:, k, :] > sims[:, k, None]) & taken).any(axis=1)
        taken[:, k] = ok
    rank = np.where((ids >= 0) & (ids != own[:, None]), np.arange(c)[None, :] + np.where(taken, 0, c), 4 * c)
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(rank, order, 1) < 4 * c, np.take_along_axis(ids, order, 1), -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


class Graph:
    """``layers[0]`` links all vectors; ``layers[k]`` links the first ``sizes[k]`` of them (vectors come highest level first)."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        levels = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(M)).astype(int)
        self.order = np.argsort(-levels, kind="stable")
        self.vectors = self.vectors[self.order]
        levels = levels[self.order]
        self.sizes = [int((levels >= k).sum()) for k in range(int(levels.max(initial=0)) + 1)]
        self.layers = [np.full((size, M0 if k == 0 else M), -1, np.int32) for k, size in enumerate(self.sizes)]
        for k in reversed(range(len(self.sizes))):
            self._fill(k)

    @classmethod
    def restored(cls, vectors: np.ndarray, layers: list[np.ndarray]) -> Graph:
        """The graph over ``vectors`` in the order of the built one, with its ``layers``."""
        graph = cls.__new__(cls)
        graph.vectors = np.ascontiguousarray(vectors, np.float32)
        graph.layers = layers
        graph.sizes = [len(links) for links in layers]
        return graph

    def _fill(self, layer: int) -> None:
        """Insert the vectors of a layer in growing batches; each batch sees what is there and itself."""
        n, links = self.sizes[layer], self.layers[layer]
        width = links.shape[1]
        done = 0
        while done < n:
            size = min(n - done, max(64, min(done // 2, 1024)))
            batch = np.arange(done, done + size)
            own = self.vectors[batch]
            ids, sims = np.zeros((size, 0), np.int64), np.zeros((size, 0), np.float32)
            if done:
                entry = self._entries(own, layer, done)
                ids, sims = beam_search(self.vectors[:done], links[:done], own, entry, min(BUILD_BEAM, done))
            among = own @ own.T
            np.fill_diagonal(among, -2)
            k = min(width, size - 1)
            if k:
                top = np.argpartition(-among, k - 1, axis=1)[:, :k]
                ids = np.concatenate((ids, batch[top]), axis=1)
                sims = np.concatenate((sims, np.take_along_axis(among, top, 1)), axis=1)
            order = np.argsort(-sims, axis=1, kind="stable")
            links[batch] = _diverse(self.vectors, batch, np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1), width)
            self._back(links, batch, width)
            done += size

    def _entries(self, queries: np.ndarray, layer: int, done: int) -> np.ndarray:
        entry = np.zeros((len(queries), 1), np.int64)
        for k in reversed(range(layer + 1, len(self.sizes))):
            size = min(self.sizes[k], done)
            if size > 1:
                links = self.layers[k][:size]
                entry, _ = beam_search(self.vectors[:size], np.where(links < size, links, -1), queries, entry, min(8, size))
        return entry

    def _back(self, links: np.ndarray, batch: np.ndarray, width: int) -> None:
        """Links back from the neighbours of a batch, thinned where there are too many."""
        to = links[batch].ravel()
        source = np.repeat(batch, width)
        source, to = source[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        source, to = source[order], to[order]
        nodes, first, counts = np.unique(to, return_index=True, return_counts=True)
        for a in range(0, len(nodes), 512):
            some = slice(a, min(a + 512, len(nodes)))
            most = int(counts[some].max())
            extra = np.full((len(nodes[some]), most), -1, np.int64)
            for row, (f, c) in enumerate(zip(first[some].tolist(), counts[some].tolist())):
                extra[row, :c] = source[f : f + c]
            if most > 4 * width:  # the nearest of very many
                s = np.where(extra >= 0, _sims(self.vectors, self.vectors[nodes[some]], extra), -2)
                extra = np.take_along_axis(extra, np.argsort(-s, axis=1, kind="stable")[:, : 4 * width], 1)
            ids = np.concatenate((links[nodes[some]], extra), axis=1)
            ids.sort(axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.where(ids >= 0, _sims(self.vectors, self.vectors[nodes[some]], ids), -2)
            order = np.argsort(-sims, axis=1, kind="stable")
            links[nodes[some]] = _diverse(self.vectors, nodes[some], np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1), width)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``vectors`` and similarities of the best found, best first."""
        queries = np.ascontiguousarray(queries, np.float32)
        return beam_search(self.vectors, self.layers[0], queries, self._entries(queries, 0, len(self.vectors)), min(beam, len(self.vectors)))
