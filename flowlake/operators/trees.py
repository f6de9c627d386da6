"""Ensembles of binary trees as flat arrays: what they answer, and why.

All nodes of all trees stand one after the other. The arrays are what is sent to tasks; their
size is linear in the nodes, whatever the depth.

Contributions are the path-dependent Shapley values. With ``T`` telling whether a row
passes the tests on a feature along a path and ``R`` the share of the training weight that
does, a leaf pays its value times the product over the path's features of ``T`` or ``R``. The
average over all coalitions is the integral over t of the product of ``T t + R (1 - t)``, a
polynomial that a few Gauss-Legendre nodes integrate exactly. So one walk down keeps the
product at these nodes, one walk up adds the leaves below each edge, and the edge's feature
gets the sum times ``(T - R) / (T t + R (1 - t))``; where a feature is tested again, the
lower edge takes the place of the upper one for the leaves below it. Work is nodes x half
the depth per row; trees are walked level by level, many rows and nodes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Nodes that are walked together (a larger tree goes alone), and numbers in one working array.
TOGETHER = 4096
CELLS = 1 << 20
#: Rows whose leaves are looked up together.
AT_ONCE = 4096
#: Levels after which rows that have come to a leaf are set aside.
STEPS = 5


@dataclass
class FlatTrees:
    """``feature`` is -1 at a leaf; a row goes left where its value is at most ``cut``.

    ``cover`` is the training weight at a node. A leaf's values are entries ``leaf_output``,
    ``leaf_value`` from ``leaf_start[node]`` to ``leaf_start[node + 1]``.
    """

    outputs: int
    start: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cover: np.ndarray
    leaf_start: np.ndarray
    leaf_output: np.ndarray
    leaf_value: np.ndarray

    @classmethod
    def joined(cls, parts: list[FlatTrees], outputs: int) -> FlatTrees:
        """Several ensembles as one."""
        nodes = np.cumsum([0, *(len(p.feature) for p in parts)])
        entries = np.cumsum([0, *(len(p.leaf_value) for p in parts)])
        whole = lambda name: np.concatenate([getattr(p, name) for p in parts])
        shifted = lambda name, by: np.concatenate([np.where(getattr(p, name) >= 0, getattr(p, name) + b, -1) for p, b in zip(parts, by)])
        starts = lambda name, by: np.concatenate([*(getattr(p, name)[:-1] + b for p, b in zip(parts, by)), [by[-1]]])
        return cls(
            outputs, starts("start", nodes), whole("feature"), whole("cut"), shifted("left", nodes), shifted("right", nodes), whole("cover"),
            starts("leaf_start", entries), whole("leaf_output"), whole("leaf_value"),
        )

    def part(self, first: int, last: int) -> FlatTrees:
        """Some consecutive trees."""
        low, high = int(self.start[first]), int(self.start[last])
        a, b = int(self.leaf_start[low]), int(self.leaf_start[high])
        child = lambda x: np.where(x[low:high] >= 0, x[low:high] - low, -1)
        return FlatTrees(
            self.outputs, self.start[first:last + 1] - low, self.feature[low:high], self.cut[low:high], child(self.left), child(self.right),
            self.cover[low:high], self.leaf_start[low:high + 1] - a, self.leaf_output[a:b], self.leaf_value[a:b],
        )

    def dense(self, nodes: np.ndarray) -> np.ndarray:
        """Values of leaves, one column per output."""
        out = np.zeros((len(nodes), self.outputs))
        sizes = self.leaf_start[nodes + 1] - self.leaf_start[nodes]
        row = np.repeat(np.arange(len(nodes)), sizes)
        at = np.repeat(self.leaf_start[nodes] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        out[row, self.leaf_output[at]] = self.leaf_value[at]
        return out

    def answers(self, rows: np.ndarray) -> np.ndarray:
        """Sum over the trees of the values of the leaf that each row reaches: (row, output)."""
        out = np.zeros((len(rows), self.outputs))
        leaf = self.feature < 0
        # A leaf leads to itself.
        own = np.arange(len(leaf))
        feature, children = np.where(leaf, 0, self.feature), np.stack([np.where(leaf, own, self.right), np.where(leaf, own, self.left)], axis=1).ravel()
        for first in range(0, len(rows), AT_ONCE):
            part = np.ascontiguousarray(rows[first:first + AT_ONCE])
            for root in self.start[:-1]:
                self.pay(out[first:first + AT_ONCE], self.reached(part, root, leaf, feature, children))
        return out

    def reached(self, rows: np.ndarray, root: int, leaf: np.ndarray, feature: np.ndarray, children: np.ndarray) -> np.ndarray:
        """The leaf of one tree that each row comes to; ``children`` has the right and left child of each node."""
        found = np.full(len(rows), root)
        if leaf[root]:
            return found
        values, width = rows.ravel(), rows.shape[1]
        at, lines = found, np.arange(len(rows))
        first = lines * width
        while len(at):
            for _ in range(STEPS):
                seen = feature.take(at)
                seen += first
                left = values.take(seen) <= self.cut.take(at)
                at = at * 2
                at += left
                at = children.take(at)
            done = leaf.take(at)
            found[lines[done]] = at[done]
            going = np.flatnonzero(~done)
            at, lines, first = at.take(going), lines.take(going), first.take(going)
        return found

    def pay(self, out: np.ndarray, at: np.ndarray) -> None:
        """Adds the values of each row's leaf to its outputs."""
        start = self.leaf_start.take(at)
        sizes = self.leaf_start.take(at + 1) - start
        lines = np.arange(len(at))
        # A leaf has an output once, so no two entries of a turn meet.
        for entry in range(int(sizes.max(initial=0))):
            if entry:
                more = np.flatnonzero(sizes > entry)
                lines, start, sizes = lines.take(more), start.take(more), sizes.take(more)
            elif (sizes < 1).any():
                some = np.flatnonzero(sizes)
                lines, start, sizes = lines.take(some), start.take(some), sizes.take(some)
            out[lines, self.leaf_output.take(start + entry)] += self.leaf_value.take(start + entry)

    def tree_outputs(self) -> np.ndarray:
        """The only output of each tree's leaves, or -1 for a tree with several."""
        found = []
        for first, last in zip(self.start[:-1], self.start[1:]):
            own = self.leaf_output[self.leaf_start[first]:self.leaf_start[last]]
            found.append(int(own[0]) if len(own) and (own == own[0]).all() else -1)
        return np.array(found, np.int64)

    def groups(self, trees: np.ndarray) -> Iterator[Walk]:
        """The given trees, some at a time."""
        held, nodes = [], 0
        for tree in trees:
            size = int(self.start[tree + 1] - self.start[tree])
            if held and nodes + size > TOGETHER:
                yield Walk(self, np.array(held))
                held, nodes = [], 0
            held.append(self.start[tree])
            nodes += size
        if held:
            yield Walk(self, np.array(held))


class Walk:
    """Some trees in levels: children of the nodes of a level stand side by side in the next."""

    def __init__(self, trees: FlatTrees, roots: np.ndarray):
        self.trees = trees
        at, levels, parents = roots, [], []
        while len(at):
            levels.append(at)
            inner = np.flatnonzero(trees.feature[at] >= 0)
            parents.append(np.repeat(inner, 2))
            at = np.stack([trees.left[at[inner]], trees.right[at[inner]]], axis=1).ravel()
        first = np.cumsum([0, *map(len, levels)])
        self.levels, self.first = levels, first
        nodes = np.concatenate(levels)
        above = np.concatenate([np.full(len(roots), -1), *(p + b for p, b in zip(parents, first))])[: len(nodes)]
        inner = above >= 0
        parent = nodes[above]
        self.feature = np.where(inner, trees.feature[parent], -1)
        self.cut = np.where(inner, trees.cut[parent], 0.0)
        self.goes_left = inner & (trees.left[parent] == nodes)
        cover = trees.cover[parent]
        ratio = np.where(inner, np.divide(trees.cover[nodes], cover, out=np.zeros(len(nodes)), where=cover > 0), 1.0)
        # The nearest edge above on the same feature.
        self.before = np.full(len(nodes), -1)
        up = np.where(inner, above, -1)
        while (up >= 0).any():
            same = (self.before < 0) & (up >= 0) & inner & (self.feature[up] == self.feature)
            self.before[same] = up[same]
            up = np.where(up >= 0, above[up], -1)
        distinct, share = np.zeros(len(nodes), int), np.ones(len(nodes))
        for low, high in zip(first[1:-1], first[2:]):
            here = slice(low, high)
            had = self.before[here]
            distinct[here] = distinct[above[here]] + (had < 0)
            share[here] = ratio[here] * np.where(had >= 0, share[had], 1.0)
        points, masses = np.polynomial.legendre.leggauss(max(1, (int(distinct.max(initial=0)) + 1) // 2))
        t, self.mass = (points + 1) / 2, masses / 2
        passes, fails = t + share[:, None] * (1 - t), share[:, None] * (1 - t)
        had = self.before
        passed_before = np.where(had[:, None] >= 0, passes[had], 1.0)
        self.step_pass, self.step_fail = passes / passed_before, fails / passed_before
        self.step_still = np.broadcast_to(ratio[:, None], passes.shape)
        gain_pass = (1 - share[:, None]) / passes
        gain_before = np.where(had[:, None] >= 0, gain_pass[had], 0.0)
        self.gain_pass = gain_pass - gain_before
        self.gain_fail = -1 / (1 - t) - gain_before
        self.above = [p for p in parents]
        self.leaves = [np.flatnonzero(trees.feature[level] < 0) for level in levels]
        self.inner = [np.flatnonzero(trees.feature[level] >= 0) for level in levels]
        self.values = [trees.dense(level[leaf]) for level, leaf in zip(levels, self.leaves)]
        self.by_feature = []
        for low, high in zip(first[:-1], first[1:]):
            order = np.argsort(self.feature[low:high], kind="stable")
            names = self.feature[low:high][order]
            at = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            self.by_feature.append((order, at, names[at]))

    @property
    def rows_at_once(self) -> int:
        return max(8, CELLS // (max(map(len, self.levels)) * len(self.mass)))

    def down(self, columns: np.ndarray) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
        """Products at the leaves of each level, and which edges rows pass and passed before."""
        rows = columns.shape[1]
        passed = np.ones((self.first[-1], rows), bool)
        product = np.ones((len(self.levels[0]), len(self.mass), rows))
        at_leaves, edges = [product[self.leaves[0]]], [(passed[:0], passed[:0])]
        for depth in range(1, len(self.levels)):
            here = slice(self.first[depth], self.first[depth + 1])
            had = self.before[here]
            test = (columns[self.feature[here]] <= self.cut[here, None]) == self.goes_left[here, None]
            earlier = np.where(had[:, None] >= 0, passed[had], True)
            passed[here] = now = test & earlier
            step = np.where(now[:, None], self.step_pass[here, :, None], np.where(earlier[:, None], self.step_fail[here, :, None], self.step_still[here, :, None]))
            product = product[self.above[depth - 1]] * step
            at_leaves.append(product[self.leaves[depth]])
            edges.append((now, earlier))
        return at_leaves, edges

    def up(self, at_leaves: list[np.ndarray], edges: list, paid: list[np.ndarray], out: np.ndarray) -> None:
        """Adds each feature's part to ``out`` (feature, row); ``paid`` is what the leaves of each level pay each row."""
        below = None
        for depth in reversed(range(1, len(self.levels))):
            here = slice(self.first[depth], self.first[depth + 1])
            sums = np.empty((len(self.levels[depth]), len(self.mass), out.shape[1]))
            sums[self.leaves[depth]] = at_leaves[depth] * self.mass[:, None] * paid[depth][:, None]
            if below is not None and len(below):
                sums[self.inner[depth]] = below[0::2] + below[1::2]
            now, earlier = edges[depth]
            gain = np.where(now[:, None], self.gain_pass[here, :, None], np.where(earlier[:, None], self.gain_fail[here, :, None], 0.0))
            part = np.einsum("nqr,nqr->nr", sums, gain)
            order, at, names = self.by_feature[depth]
            out[names] += np.add.reduceat(part[order], at, axis=0)
            below = sums


def contributions(rows: np.ndarray, trees: FlatTrees) -> np.ndarray:
    """Shapley values of every output: (row, output, feature)."""
    result = np.zeros((trees.outputs, rows.shape[1], len(rows)))
    columns, single = np.ascontiguousarray(rows.T), trees.tree_outputs()
    for output in np.unique(single):
        for walk in trees.groups(np.flatnonzero(single == output)):
            for first in range(0, len(rows), walk.rows_at_once):
                part = slice(first, first + walk.rows_at_once)
                at_leaves, edges = walk.down(columns[:, part])
                for k in range(trees.outputs) if output < 0 else [output]:
                    walk.up(at_leaves, edges, [v[:, k, None] for v in walk.values], result[k, :, part])
    return result.transpose(2, 0, 1)


def own_contributions(rows: np.ndarray, trees: FlatTrees, own: np.ndarray) -> np.ndarray:
    """Shapley values of one output per row, ``own``: (row, feature)."""
    result, single = np.zeros((rows.shape[1], len(rows))), trees.tree_outputs()
    for output in np.unique(single):
        mine = np.flatnonzero(own == output) if output >= 0 else np.arange(len(rows))
        columns = np.ascontiguousarray(rows[mine].T)
        for walk in trees.groups(np.flatnonzero(single == output)) if len(mine) else ():
            for first in range(0, len(mine), walk.rows_at_once):
                at = mine[first:first + walk.rows_at_once]
                at_leaves, edges = walk.down(columns[:, first:first + walk.rows_at_once])
                found = np.zeros((rows.shape[1], len(at)))
                walk.up(at_leaves, edges, [v[:, own[at]] for v in walk.values], found)
                result[:, at] += found
    return result.T
