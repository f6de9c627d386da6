"""Random forests of deep trees, trained by DataFrame aggregates and grouped subtrees.

A deep tree has about as many nodes as rows, so histograms of every node, which Spark's own
forest adds up and shuffles, cost far more than the rows they describe. Here

* features become bin numbers once and rows are stored as blocks of bytes, as for boosting;
* each tree weighs each row by a Poisson count that follows from the tree's and the block's
  number, so a repeated task draws the same;
* nodes of more than ``LOCAL`` rows are split by histograms merged over the tasks, level by level,
  on the node's own features only; the driver gets one split per node;
* the rows of a smaller node go to one group, which grows the whole subtree below it, a level at a
  time: all nodes of a level are sorted and scanned together. Groups hold at most ``LOCAL`` rows, and
  as many trees are grown together as ``TOGETHER`` bytes of rows allow.

A node looks at the square root of the features, drawn anew, and splits where the weighted Gini
impurity falls most. Sibling leaves that predict the same class become one leaf, as in Spark.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import functions as MF
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.operators.boosting import bin_edges, store_blocks
from flowlake.operators.trees import FlatTrees
from flowlake.session import materialize

BINS = 64
#: Rows of a node whose subtree one group grows, and bytes of rows that go to groups at a time.
LOCAL = 100_000
TOGETHER = 4_000_000_000
#: Bytes of histograms that one task adds up at a time.
SUMS = 64_000_000
#: Nodes in a stored row, and bytes of rows that are written at a time.
PIECE = 100_000
WRITTEN = 128_000_000
LEAST_GAIN = 1e-9
SAVED = ("feature", "cut", "left", "right", "cover", "leaf_start", "leaf_output", "leaf_value")
ROWS = "tree int, node bigint, labels binary, weights binary, bins binary"
SUBTREES = "tree int, node bigint, nodes binary"


@dataclass
class Plan:
    """What every task knows: bins, classes, features per node, depth and seed."""

    counts: list[int]
    classes: int
    bins: int
    looked: int
    depth: int
    seed: int

    def draw(self, tree: int, nodes: np.ndarray) -> np.ndarray:
        """The features that each node looks at: (node, slot). Nodes are numbered 1, 2 and 3, 4 to 7, ... as in a heap."""
        rng = np.random.default_rng([self.seed, 1, tree, *(int(nodes[0]) >> s & 0xFFFFFFFF for s in (0, 32))]) if len(nodes) else None
        if rng is None or self.looked >= len(self.counts):
            return np.tile(np.arange(len(self.counts)), (len(nodes), 1))
        return np.argpartition(rng.random((len(nodes), len(self.counts))), self.looked - 1, axis=1)[:, :self.looked]

    def drawn(self, tree: int, block: int, rows: int) -> np.ndarray:
        """How often each row of a block stands in the tree's sample."""
        return np.random.default_rng([self.seed, 0, tree, block & 0xFFFFFFFF, block >> 32]).poisson(1.0, rows)


@dataclass
class Nodes:
    """Nodes of a tree from the top; children stand side by side behind their parents, ``left`` is -1 at a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **vars(self))
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Nodes:
        return cls(**np.load(io.BytesIO(data)))

    def pruned(self) -> Nodes:
        """Sibling leaves of one prediction become a leaf, bottom up; what is left moves together."""
        left, says = self.left.copy(), self.stats.argmax(axis=1)
        todo = np.flatnonzero(left >= 0)
        while len(todo):
            a, b = left[todo], left[todo] + 1
            same = (left[a] < 0) & (left[b] < 0) & (says[a] == says[b])
            if not same.any():
                break
            left[todo[same]] = -1
            todo = todo[~same]
        kept = np.zeros(len(left), bool)
        at = np.array([0])
        while len(at):
            kept[at] = True
            down = left[at]
            down = down[down >= 0]
            at = np.concatenate([down, down + 1])
        number = np.cumsum(kept) - 1
        left = np.where(left >= 0, number[left], -1)[kept]
        inner = left >= 0
        return Nodes(np.where(inner, self.feature[kept], -1), self.bin[kept], left, np.where(inner, self.gain[kept], 0.0), self.stats[kept])


def best_cuts(left: np.ndarray, whole: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node the largest fall of impurity and the row of ``left`` (class sums up to a cut, node by node) where it is."""
    total = whole.sum(axis=1)
    right = whole[node] - left
    w_left, w_right = left.sum(axis=1), right.sum(axis=1)
    least = 1e-9 * total[node]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left * left).sum(axis=1) / w_left + (right * right).sum(axis=1) / w_right
    gain = np.where((w_left > least) & (w_right > least), gain, -np.inf)
    first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    best = np.maximum.reduceat(gain, first)
    at = np.flatnonzero(gain == best[np.repeat(np.arange(len(first)), np.diff(np.append(first, len(node))))])
    _, one = np.unique(node[at], return_index=True)
    return (best - (whole * whole).sum(axis=1) / total) / total, at[one]


def grow_below(plan: Plan, tree: int, node: int, labels: np.ndarray, weights: np.ndarray, bins: np.ndarray) -> Nodes:
    """The subtree below one node from all its rows, a level at a time; rows stay ordered by their node."""
    k, width = plan.classes, plan.bins
    names, first_of_level, level_nodes = np.array([node], object), 0, []
    at, ids = np.zeros(len(labels), np.intp), np.arange(len(labels))
    level = node.bit_length() - 1
    while len(names):
        m = len(names)
        label, weight = labels[ids], weights[ids]
        stats = np.bincount(at * k + label, weight, m * k).reshape(m, k)
        feature, bin_, gain = np.full(m, -1, np.int16), np.zeros(m, np.uint8), np.zeros(m)
        open_ = np.flatnonzero((stats > 0).sum(axis=1) > 1) if level < plan.depth else np.zeros(0, np.intp)
        if len(open_):
            place = np.full(m, -1)
            place[open_] = np.arange(len(open_))
            mine = place[at] >= 0
            ids, here, label, weight = ids[mine], place[at[mine]], label[mine], weight[mine]
            whole, looked = stats[open_], plan.draw(tree, names[open_])
            dense = len(open_) * width * k <= 4 * len(ids)
            top, top_feature, top_bin = np.full(len(open_), LEAST_GAIN), np.full(len(open_), -1), np.zeros(len(open_), np.intp)
            for slot in range(looked.shape[1]):
                value = bins[looked[here, slot], ids].astype(np.intp)
                key = here * width + value
                if dense:
                    left = np.bincount(key * k + label, weight, len(open_) * width * k).reshape(-1, width, k).cumsum(axis=1).reshape(-1, k)
                    run_node, run_bin = np.divmod(np.arange(len(left)), width)
                else:
                    order = np.argsort(key, kind="stable")
                    key = key[order]
                    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
                    run_node, run_bin = np.divmod(key[last], width)
                    run = np.repeat(np.arange(len(last)), np.diff(np.append(-1, last)))
                    sums = np.bincount(run * k + label[order], weight[order], len(last) * k).reshape(-1, k).cumsum(axis=0)
                    start = np.flatnonzero(np.append(True, run_node[1:] != run_node[:-1]))
                    before = np.concatenate([np.zeros((1, k)), sums])[start]
                    left = sums - before[run_node]
                    left[np.append(start[1:] - 1, len(left) - 1)] = whole
                found, cut = best_cuts(left, whole, run_node)
                better = found > top
                top[better], top_feature[better], top_bin[better] = found[better], looked[better, slot], run_bin[cut[better]]
            splits = top_feature >= 0
            feature[open_], bin_[open_], gain[open_] = top_feature, top_bin, np.where(splits, top, 0.0)
            rows = splits[here]
            ids, here = ids[rows], here[rows]
            right = bins[top_feature[here], ids] > top_bin[here]
            number = np.cumsum(splits) - 1
            at = 2 * number[here] + right
            order = np.argsort(at, kind="stable")
            at, ids = at[order], ids[order]
            parents = names[open_[splits]]
        else:
            parents = names[:0]
        inner = feature >= 0
        left = np.full(m, -1, np.int64)
        left[inner] = first_of_level + m + 2 * np.arange(int(inner.sum()))
        level_nodes.append((feature, bin_, left, gain, stats))
        first_of_level += m
        names = np.stack([2 * parents, 2 * parents + 1], axis=1).ravel()
        level += 1
    return Nodes(*(np.concatenate(parts) for parts in zip(*level_nodes))).pruned()


# ---- the upper levels ----------------------------------------------------------


@dataclass
class Top:
    """The upper nodes of one tree, by heap number: feature, bin, gain and class sums of splits, class sums of leaves, other nodes by their size."""

    splits: dict[int, tuple[int, int, float, np.ndarray]]
    leaves: dict[int, np.ndarray]
    large: list[int]
    small: list[int]

    def tests(self) -> tuple[np.ndarray, ...]:
        """What tasks need: heap numbers, features and cuts of all nodes above the lowest, and the place of each left child."""
        names = [1, *(c for n in sorted(self.splits) for c in (2 * n, 2 * n + 1))]
        place = {n: i for i, n in enumerate(names)}
        # A leaf leads to itself: no bin number is above 255.
        found = [(n, *(self.splits[n][:2] + (place[2 * n],) if n in self.splits else (0, 255, place[n]))) for n in names]
        levels = max(names).bit_length() - 1
        return (*(np.array(x, np.int64) for x in zip(*found)), np.int64(levels))


def reached(tests: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The lowest known node that each row (a column of ``bins``) has come to."""
    names, feature, cut, left, levels = tests
    rows = bins.shape[1]
    at, lines, values, first = np.zeros(rows, np.intp), np.arange(rows), bins.ravel(), feature * rows
    for _ in range(levels):
        at = left[at] + (values[first[at] + lines] > cut[at])
    return names[at]


def _unpack(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for number, labels, weights, bins in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("block", "labels", "weights", "bins"))):
        labels = np.frombuffer(labels, np.int32)
        yield number, labels, np.frombuffer(weights, float), np.frombuffer(bins, np.uint8).reshape(width, len(labels))


def split_large(blocks: DataFrame, plan: Plan, tops: dict[int, Top]) -> None:
    """One level: the best split of each large node; without one it is a leaf, else its children are large or small."""
    cells = plan.looked * plan.bins * plan.classes
    wanted = [(tree, node) for tree, top in tops.items() for node in top.large]
    step = max(1, SUMS // (8 * cells))
    for first in range(0, len(wanted), step):
        part = wanted[first:first + step]
        by_tree: dict[int, list[int]] = {}
        for tree, node in part:
            by_tree.setdefault(tree, []).append(node)
        known = {tree: tops[tree].tests() for tree in by_tree}

        def add_up(batches: Iterator[pa.RecordBatch], by_tree=by_tree, known=known) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for number, labels, weights, bins in _unpack(batch, len(plan.counts)):
                    for tree, nodes in by_tree.items():
                        times = plan.drawn(tree, number, len(labels))
                        at = reached(known[tree], bins)
                        for node in nodes:
                            rows = np.flatnonzero((at == node) & (times > 0))
                            if not len(rows):
                                continue
                            weight, label = weights[rows] * times[rows], labels[rows]
                            total = sums.setdefault((tree, node), np.zeros(1 + 2 * cells))
                            total[0] += len(rows)
                            for slot, feature in enumerate(plan.draw(tree, np.array([node], object))[0]):
                                key = (slot * plan.bins + bins[feature, rows].astype(np.intp)) * plan.classes + label
                                total[1:1 + cells] += np.bincount(key, weight, cells)
                                total[1 + cells:] += np.bincount(key, None, cells)
            for (tree, node), total in sums.items():
                yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "node": [node], "sums": [total.tobytes()]})

        def choose(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(s) for s in table["sums"].to_pylist())
            tree, node = table["tree"][0].as_py(), table["node"][0].as_py()
            weights, rows = (x.reshape(plan.looked, plan.bins, plan.classes) for x in (total[1:1 + cells], total[1 + cells:]))
            whole = weights[0].sum(axis=0)[None]
            best = (LEAST_GAIN, -1, 0, 0)
            for slot, feature in enumerate(plan.draw(tree, np.array([node], object))[0]):
                gain, cut = best_cuts(weights[slot].cumsum(axis=0), whole, np.zeros(plan.bins, np.intp))
                if gain[0] > best[0]:
                    best = (float(gain[0]), int(feature), int(cut[0]), int(rows[slot, :cut[0] + 1].sum()))
            return pa.table({
                "tree": table["tree"][:1], "node": table["node"][:1], "gain": [best[0]], "feature": pa.array([best[1]], pa.int32()),
                "bin": pa.array([best[2]], pa.int32()), "left": [best[3]], "rows": [int(total[0])], "stats": [whole[0].tolist()],
            })

        sums = blocks.mapInArrow(add_up, "tree int, node bigint, sums binary")
        found = sums.groupBy("tree", "node").applyInArrow(
            choose, "tree int, node bigint, gain double, feature int, bin int, left bigint, rows bigint, stats array<double>"
        ).collect()
        for r in sorted(found):
            top, node = tops[r["tree"]], r["node"]
            top.large.remove(node)
            if r["feature"] < 0 or node.bit_length() > plan.depth:
                top.leaves[node] = np.array(r["stats"])
                continue
            top.splits[node] = (r["feature"], r["bin"], r["gain"], np.array(r["stats"]))
            for child, rows in ((2 * node, r["left"]), (2 * node + 1, r["rows"] - r["left"])):
                (top.large if rows > LOCAL else top.small).append(child)


def grow_small(blocks: DataFrame, plan: Plan, tops: dict[int, Top], groups: int) -> list:
    """The subtrees of all small nodes, each grown by one group from its rows."""
    known = {tree: (top.tests(), np.array(top.small, np.int64)) for tree, top in tops.items() if top.small}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, labels, weights, bins in _unpack(batch, len(plan.counts)):
                for tree, (tests, small) in known.items():
                    times = plan.drawn(tree, number, len(labels))
                    at = np.where(times > 0, reached(tests, bins), 0)
                    for node in np.intersect1d(at, small):
                        rows = np.flatnonzero(at == node)
                        columns = (labels[rows].astype(np.int16), (weights[rows] * times[rows]), bins[:, rows])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tree], pa.int32()), pa.array([int(node)], pa.int64()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                            names=["tree", "node", "labels", "weights", "bins"],
                        )

    def grow(table: pa.Table) -> pa.Table:
        tree, node = table["tree"][0].as_py(), table["node"][0].as_py()
        labels, weights, bins = (table[n].to_pylist() for n in ("labels", "weights", "bins"))
        columns = [np.frombuffer(x, np.uint8).reshape(len(plan.counts), -1) for x in bins]
        order = sorted(range(len(columns)), key=lambda i: (bins[i], labels[i], weights[i]))  # sums do not depend on the order of arrival
        joined = lambda parts, kind: np.concatenate([np.frombuffer(parts[i], kind) for i in order])
        found = grow_below(plan, tree, node, joined(labels, np.int16).astype(np.intp), joined(weights, float), np.concatenate([columns[i] for i in order], axis=1))
        return pa.table({"tree": table["tree"][:1], "node": table["node"][:1], "nodes": pa.array([found.packed()], pa.binary())})

    rows = blocks.mapInArrow(send, ROWS).repartition(groups, "tree", "node")
    found = rows.groupBy("tree", "node").applyInArrow(grow, SUBTREES)
    table = found.toArrow()
    return list(zip(table["tree"].to_pylist(), table["node"].to_pylist(), table["nodes"].to_pylist()))


def assembled(top: Top, below: dict[int, Nodes], classes: int) -> Nodes:
    """A whole tree from its upper splits and its subtrees; a node without rows is a leaf without weight."""
    leaf = lambda sums: Nodes(np.array([-1], np.int16), np.zeros(1, np.uint8), np.array([-1]), np.zeros(1), sums[None])
    upper = sorted(top.splits)
    # Upper nodes first, then the subtrees' roots beside each other, then what is below them.
    ordered = [1] if not upper else [1, *(c for n in upper for c in (2 * n, 2 * n + 1))]
    place = {n: i for i, n in enumerate(ordered)}
    size = len(ordered)
    feature, bin_, left, gain, stats = [-1] * size, [0] * size, [-1] * size, [0.0] * size, [np.zeros(classes)] * size
    rest = []
    for n in ordered:
        i = place[n]
        if n in top.splits:
            feature[i], bin_[i], gain[i], stats[i] = top.splits[n]
            left[i] = place[2 * n]
            continue
        own = below.get(n) or leaf(top.leaves.get(n, np.zeros(classes)))
        shift = size - 1
        feature[i], bin_[i], gain[i], stats[i] = own.feature[0], own.bin[0], own.gain[0], own.stats[0]
        left[i] = own.left[0] + shift if own.left[0] >= 0 else -1
        rest.append((own.feature[1:], own.bin[1:], np.where(own.left[1:] >= 0, own.left[1:] + shift, -1), own.gain[1:], own.stats[1:]))
        size += len(own.feature) - 1
    head = (np.array(feature, np.int16), np.array(bin_, np.uint8), np.array(left, np.int64), np.array(gain, float), np.array(stats))
    return Nodes(*(np.concatenate(parts) for parts in zip(head, *rest))).pruned()


# ---- the model -----------------------------------------------------------------


@dataclass
class ForestModel:
    """Trees whose class shares add up to the probability; ``gains`` has the fall of impurity at every node."""

    trees: FlatTrees
    gains: np.ndarray

    @property
    def importances(self) -> np.ndarray:
        """Share of each feature in the weighted gains of a tree, averaged over the trees that have splits."""
        trees, width = self.trees, int(self.trees.feature.max(initial=0)) + 1
        tree = np.repeat(np.arange(len(trees.start) - 1), np.diff(trees.start))
        inner = np.flatnonzero(trees.feature >= 0)
        sums = np.bincount(tree[inner] * width + trees.feature[inner], self.gains[inner] * trees.cover[inner], (len(trees.start) - 1) * width).reshape(-1, width)
        sums = sums[sums.sum(axis=1) > 0]
        return (sums / sums.sum(axis=1, keepdims=True)).sum(axis=0) / max(1, len(sums))

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``rawPrediction`` and ``probability`` as vectors for a vector column ``features``."""
        sent = rows.sparkSession.sparkContext.broadcast(self.trees)

        @F.pandas_udf("array<double>")
        def shares(vectors: pd.Series) -> pd.Series:
            found = sent.value.answers(np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, 1)))
            return pd.Series(list(found), index=vectors.index, dtype=object)

        scored = rows.withColumn("__p", shares(MF.vector_to_array("features")))
        raw = F.transform("__p", lambda p: p * float(len(self.trees.start) - 1))
        return scored.withColumns({"rawPrediction": MF.array_to_vector(raw), "probability": MF.array_to_vector("__p")}).drop("__p")

    def save(self, spark: SparkSession, path: str) -> None:
        """A row per tree, or per ``PIECE`` nodes of a larger one, with the nodes and the entries of leaves as arrays."""
        held, size, mode = [], 0, "overwrite"
        for row in self.pieces():
            held.append(pa.Table.from_pylist([row]))
            size += held[-1].nbytes
            if size > WRITTEN:
                self.write(spark, held, path, mode)
                held, size, mode = [], 0, "append"
        if held:
            self.write(spark, held, path, mode)

    def pieces(self) -> Iterator[dict]:
        trees = self.trees
        for tree, low in enumerate(trees.start[:-1]):
            one = trees.part(tree, tree + 1)
            nodes = len(one.feature)
            for piece, first in enumerate(range(0, nodes, PIECE)):
                last = min(nodes, first + PIECE)
                entries = slice(int(one.leaf_start[first]), int(one.leaf_start[last]))
                row = {n: getattr(one, n)[entries if n in ("leaf_output", "leaf_value") else slice(first, last + (n == "leaf_start" and last == nodes))] for n in SAVED}
                about = {"tree": tree, "piece": piece, "outputs": trees.outputs, "forest_nodes": len(trees.feature)}
                yield about | {"gain": self.gains[low + first:low + last]} | row

    @staticmethod
    def write(spark: SparkSession, held: list[pa.Table], path: str, mode: str) -> None:
        """Each piece is a partition of its own, so that no task carries more than one."""
        spark.createDataFrame(pa.concat_tables(held)).write.mode(mode).parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        table = spark.read.parquet(path).toArrow()
        # Forests were once stored with a row per tree.
        table = table.sort_by([("tree", "ascending"), *([("piece", "ascending")] if "piece" in table.column_names else [])])
        column = lambda name, rows: np.concatenate([table[name][i].values.to_numpy() for i in rows])
        by_tree: dict[int, list[int]] = {}
        for i, tree in enumerate(table["tree"].to_pylist()):
            by_tree.setdefault(tree, []).append(i)
        parts, outputs = [], table["outputs"][0].as_py()
        for rows in by_tree.values():
            arrays = [column(n, rows) for n in SAVED]
            parts.append(FlatTrees(outputs, np.array([0, len(arrays[0])]), *arrays))
        trees = FlatTrees.joined(parts, outputs)
        if "forest_nodes" in table.column_names and table["forest_nodes"][0].as_py() != len(trees.feature):
            raise ValueError(f"the forest in {path} is not complete")
        return cls(trees, column("gain", range(len(table))))


def flat(tree: Nodes, edges: list[np.ndarray], share: float) -> FlatTrees:
    """A tree whose leaves pay their class shares times ``share``."""
    leaf, cover = tree.left < 0, tree.stats.sum(axis=1)
    node, entry = np.nonzero(np.where(leaf[:, None], tree.stats, 0.0))
    offset, cuts = np.cumsum([0, *map(len, edges)]), np.concatenate([*edges, [0.0]])
    at = np.where(leaf, len(cuts) - 1, offset[tree.feature] + tree.bin)
    return FlatTrees(
        tree.stats.shape[1], np.array([0, len(leaf)]), tree.feature.astype(np.int64), cuts[at], tree.left, np.where(leaf, -1, tree.left + 1), cover,
        np.searchsorted(node, np.arange(len(leaf) + 1)), entry, tree.stats[node, entry] / cover[node] * share,
    )


def checked(rows: DataFrame, vector: str, label: str, weight: str | None) -> DataFrame:
    """Rows that cannot be learnt from are errors, with the words of Spark's models."""
    odd = lambda c: c.isNull() | F.isnan(c)
    endless = lambda c: F.abs(c) == float("inf")
    rules = [
        (odd(F.col(label).cast("double")), "Labels MUST NOT be Null or NaN"),
        (F.col(vector).isNull(), "Vectors MUST NOT be Null"),
        (F.exists(MF.vector_to_array(vector), lambda x: odd(x) | endless(x)), "Vector values MUST NOT be NaN or Infinity"),
    ]
    if weight:
        given = F.col(weight).cast("double")
        rules.append((odd(given) | endless(given) | (given < 0), "Weights MUST NOT be Null, NaN, Infinity or Negative"))
    for wrong, message in rules:
        rows = rows.filter(F.when(wrong, F.raise_error(message).cast("boolean")).otherwise(True))
    return rows


def fit(
    rows: DataFrame, vector: str, label: str, classes: int, weight: str | None = None, trees: int = 100, depth: int = 20, bins: int = BINS, seed: int = 42,
) -> ForestModel:
    """A forest on a vector column and class numbers; a single tree looks at all features."""
    if not 2 <= bins <= 256:
        raise ValueError("bins are kept in bytes: 2 to 256 of them")
    if not 0 <= depth <= 60:
        raise ValueError("nodes are numbered in 62 bits: a depth of 0 to 60")
    rows = checked(rows, vector, label, weight)
    first = rows.first()
    if first is None:
        raise ValueError("there are no rows to train on")
    width = int(first[vector].size)
    edges = bin_edges(rows, vector, width, bins)
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    packed = store_blocks(rows, vector, label, weight, edges, 0).drop("margins")
    # The number of a block is stored with it, as the samples follow from it.
    blocks = materialize(packed.repartition(cores).withColumn("block", F.monotonically_increasing_id()), "forest-blocks")
    total = int(blocks.agg(F.sum(F.length("labels"))).first()[0]) // 4
    looked = width if trees == 1 else math.ceil(math.sqrt(width))
    plan = Plan([len(e) + 1 for e in edges], classes, bins, looked, depth, seed)
    step = max(1, min(trees, int(TOGETHER // max(1, total * (width + 10)))))
    parts, gains = [], []
    for start in range(0, trees, step):
        tops = {tree: Top({}, {}, *(([1], []) if total > LOCAL else ([], [1]))) for tree in range(start, min(trees, start + step))}
        while any(top.large for top in tops.values()):
            split_large(blocks, plan, tops)
        below: dict[int, dict[int, Nodes]] = {tree: {} for tree in tops}
        for tree, node, nodes in grow_small(blocks, plan, tops, 4 * cores):
            below[tree][node] = nodes
        for tree, top in tops.items():
            found = assembled(top, {node: Nodes.unpacked(data) for node, data in below.pop(tree).items()}, classes)
            parts.append(flat(found, edges, 1.0 / trees))
            gains.append(found.gain)
    return ForestModel(FlatTrees.joined(parts, classes), np.concatenate(gains))
