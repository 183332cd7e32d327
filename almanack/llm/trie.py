"""Similarity self-join of sets over a prefix tree, in one task.

Sets are sequences in one global order, that of the tokens' hashes, which is the same in
every task, kept in a path-compressed prefix tree.  A probe goes
down the tree a few tokens of every live path at a time: paths that share a
prefix share the partial overlap counted on it.  A subtree is left when the
overlap so far plus what can still match (the shorter of what remains of the
probe and of the longest set below) is too little for its shortest set.
"""

from __future__ import annotations

import numpy as np

#: Tokens looked at per path and round.
STRIDE = 48


class Trie:
    """``sets``: distinct token hashes of each set, any order; ``cells``: see :func:`links`."""

    def __init__(self, sets: list[np.ndarray], cells: np.ndarray):
        sizes = np.array([len(s) for s in sets])
        distinct, tokens = np.unique(np.concatenate(sets), return_inverse=True)
        ordered = [np.sort(t) for t in np.split(tokens, np.cumsum(sizes)[:-1])]
        self.order = np.array(sorted(range(len(ordered)), key=lambda i: ordered[i].astype(">u4").tobytes()))
        self.sets = [ordered[i] for i in self.order]
        self.cells = cells[self.order]
        self.sizes = sizes[self.order]
        self.held = np.zeros(len(distinct), bool)  # tokens of the probe
        self._grow()

    def _grow(self) -> None:
        """Nodes from the common prefixes of neighbours in sorted order."""
        sets, m = self.sets, len(self.sets)
        common = [0] * (m + 1)
        for i in range(1, m):
            a, b = sets[i - 1], sets[i]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            common[i] = int(differ[0]) if len(differ) else n
        # (depth, first leaf) of the open path; closing a part of it makes a node
        nodes: list[list[int]] = []  # leaf that has the tokens, from, to, first leaf, end leaf, parent
        open_path: list[list[int]] = [[0, 0, -1]]  # depth, first leaf, nodes below wait in children
        children: list[list[int]] = [[]]
        for i in range(m):
            depth = common[i]
            self._close(nodes, open_path, children, depth, i)
            open_path.append([len(sets[i]), i])
            children.append([])
        self._close(nodes, open_path, children, 0, m)
        table = np.array(nodes, np.int64).reshape(-1, 6)
        self.leaf, self.start, self.stop, self.low, self.high, self.parent = table.T
        self.root = np.flatnonzero(self.parent < 0)
        kids = np.argsort(self.parent, kind="stable")
        kids = kids[len(self.root) :]
        self.kids = kids
        self.kid_from = np.searchsorted(self.parent[kids], np.arange(len(table)))
        self.kid_to = np.searchsorted(self.parent[kids], np.arange(len(table)), "right")
        base = np.zeros(m + 1, np.int64)
        np.cumsum([len(s) for s in sets], out=base[1:])
        self.tokens = np.concatenate([*sets, np.zeros(STRIDE, np.int64)])
        self.at = base[self.leaf] + self.start
        self.longest = np.array([self.sizes[a:b].max() for a, b in zip(self.low, self.high)])
        self.shortest = np.array([self.sizes[a:b].min() for a, b in zip(self.low, self.high)])

    @staticmethod
    def _close(nodes, open_path, children, depth: int, end: int) -> None:
        while open_path[-1][0] > depth or (open_path[-1][0] == depth and len(open_path) > 1 and open_path[-2][0] >= depth):
            bottom, first = open_path.pop()[:2]
            below = children.pop()
            if open_path[-1][0] < depth:  # cut the path at the depth where the next set leaves it
                open_path.append([depth, first])
                children.append([])
            nodes.append([first, max(open_path[-1][0], 0), bottom, first, end, -1])
            for k in below:
                nodes[k][5] = len(nodes) - 1
            children[-1].append(len(nodes) - 1)

    def partners(self, i: int, percent: int) -> np.ndarray:
        """Leaves after ``i`` whose set has ``100 * shared >= percent * united`` with that of leaf ``i``."""
        own = self.sets[i]
        n = len(own)
        held = self.held
        held[own] = True
        node = self.root
        shared = np.zeros(len(node), np.int64)
        done = self.start[node].copy()
        found = []
        while len(node):
            # drop what lies before the probe or is too short or long
            ok = (self.high[node] > i + 1) & (100 * self.longest[node] >= percent * n) & (100 * n >= percent * self.shortest[node])
            node, shared, done = node[ok], shared[ok], done[ok]
            if not len(node):
                break
            at = self.at[node] + done - self.start[node]
            left = np.minimum(self.stop[node] - done, STRIDE)
            seen = held[self.tokens[at[:, None] + np.arange(STRIDE)]] & (np.arange(STRIDE) < left[:, None])
            shared = shared + seen.sum(1)
            done = done + left
            last = self.tokens[at + np.maximum(left, 1) - 1]
            rest = np.where(left > 0, n - np.searchsorted(own, last, "right"), n)
            best = shared + np.minimum(self.longest[node] - done, rest)
            ok = (100 + percent) * best >= percent * (n + self.shortest[node])
            node, shared, done = node[ok], shared[ok], done[ok]
            over = done >= self.stop[node]
            ended, ended_shared = node[over], shared[over]
            if len(ended):
                # sets that end at these nodes: sorted order puts them first
                for k, s in zip(ended.tolist(), ended_shared.tolist()):
                    leaf = int(self.low[k])
                    while leaf < self.high[k] and self.sizes[leaf] == self.stop[k]:
                        if leaf > i and (100 + percent) * s >= percent * (n + self.sizes[leaf]):
                            found.append(leaf)
                        leaf += 1
                counts = self.kid_to[ended] - self.kid_from[ended]
                below = np.repeat(self.kid_from[ended] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                kids = self.kids[below]
                node = np.concatenate((node[~over], kids))
                shared = np.concatenate((shared[~over], np.repeat(ended_shared, counts)))
                done = np.concatenate((done[~over], self.start[kids]))
        held[own] = False
        return np.array(found, np.int64)


def links(sets: list[np.ndarray], cells: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of positions that link and between them connect all that link (a forest).

    Cells -1 are compared with each other, cells 0 with cells 1.  Sets are distinct and not empty.
    """
    if len(sets) < 2:
        return []
    trie = Trie(sets, cells)
    top = list(range(len(sets)))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    order, side = trie.order.tolist(), trie.cells
    for i in range(len(sets) - 1):
        for j in trie.partners(i, percent).tolist():
            if side[i] == side[j] and side[i] >= 0:
                continue
            a, b = root(i), root(j)
            if a != b:
                top[max(a, b)] = min(a, b)
                out.append((order[i], order[j]))
    return out
