"""Gradient-boosted trees for several classes in one model, trained by distributed histograms.

Every round grows one tree per class from the gradients and hessians of the softmax loss
(of the logistic loss for two classes), level by level, with splits on histograms:

* features become bin numbers once, by bounded sketches of their quantiles; rows are
  stored as blocks of bytes, with labels, weights and margins beside them;
* features with few bins share a column of codes (``Codes``), as long as the product of their bins
  fits a byte; a histogram of codes is summed up to those of its features once per task and level;
* for a level, a task adds up gradient and hessian per class, node and code over its
  blocks, whatever their number, one column after the other, so that the sums being added to
  stay small. Of two siblings only the one with fewer rows is added up, the other is the
  difference to their parent. The driver adds up the tasks' histograms, which do not grow with
  the rows; larger ones are merged by (class, node) first, and where even one set of them is
  too large, only the best split of each node reaches the driver;
* the blocks are dealt evenly over the session's cores, however few files the rows came in;
* the blocks with their margins are kept in memory, or on the executors' disks where they do not fit,
  each round from those of the round before, and stored every ``REFRESH`` rounds. So lineage never
  grows and a lost executor repeats few rounds;
* at most ``LOCAL`` rows are not worth a job per level: one task makes all rounds with the same steps.

A node splits where the second-order gain is positive and both sides have at least
``least_weight`` of hessian; a leaf pays ``-rate * G / (H + l2)``. Of splits that gain the same up to
rounding, the first is taken. Nothing is drawn at random.
"""

from __future__ import annotations

import io
import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import functions as MF
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.operators.trees import FlatTrees
from flowlake.session import materialize, scratch_path

BINS = 64
REFRESH = 25
BLOCK_ROWS = 8192
#: Rows of neighbouring blocks that a task adds up together.
TOGETHER = 16384
#: Rows from which rounds are worth jobs of their own.
LOCAL = 100_000
#: Rows that tell which of two siblings is likely to have fewer; they decide nothing else.
PROBE = 2048
#: Bytes of histograms that the driver adds up itself, and partial histograms that one group merges.
DIRECT = 64_000_000
MERGED = 256
#: Codes of a column, and gains that count as equal.
CODES = 256
ALIKE = 1e-10
BLOCKS = "labels binary, weights binary, bins binary, margins binary"


@dataclass
class Tree:
    """A growing tree on bin numbers: per node its feature (-1: leaf), bin, children, cover and value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    cover: list[float] = field(default_factory=lambda: [0.0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def depth(self) -> int:
        """Tests on the longest path; children stand behind their parents."""
        below = [0] * len(self.feature)
        for node, left in enumerate(self.left):
            if left >= 0:
                below[left] = below[left + 1] = below[node] + 1
        return max(below)

    def split(self, node: int, feature: int, bin_: int, left: tuple[float, float], right: tuple[float, float]) -> None:
        """``left`` and ``right`` are the value and cover of the new leaves."""
        self.feature[node], self.bin[node], self.left[node] = feature, bin_, len(self.feature)
        for value, cover in (left, right):
            for name, item in zip(("feature", "bin", "left", "cover", "value"), (-1, 0, -1, cover, value)):
                getattr(self, name).append(item)


@dataclass
class BoostedModel:
    """Trees that add up to margins; their softmax (for one output the logistic) is the probability."""

    trees: FlatTrees
    gains: np.ndarray

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``rawPrediction`` and ``probability`` as vectors for a vector column ``features``."""
        sent = rows.sparkSession.sparkContext.broadcast(self.trees)

        @F.pandas_udf("array<double>")
        def margins(vectors: pd.Series) -> pd.Series:
            found = sent.value.answers(np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, 1)))
            return pd.Series(list(found if found.shape[1] > 1 else np.concatenate([-found, found], axis=1)), index=vectors.index, dtype=object)

        raw = margins(MF.vector_to_array("features"))
        scored = rows.withColumn("__raw", raw)
        top = F.array_max("__raw")
        scale = 1.0 if self.trees.outputs > 1 else 0.5  # one margin stands on both sides
        odds = F.transform("__raw", lambda m: F.exp((m - top) * scale))
        scored = scored.withColumn("__odds", odds)
        total = F.aggregate("__odds", F.lit(0.0), lambda a, x: a + x)
        scored = scored.withColumns({"rawPrediction": MF.array_to_vector("__raw"), "probability": MF.array_to_vector(F.transform("__odds", lambda o: o / total))})
        return scored.drop("__raw", "__odds")

    @property
    def importances(self) -> np.ndarray:
        """Share of each feature in the total gain of all splits."""
        return self.gains / self.gains.sum() if self.gains.sum() else self.gains

    def save(self, spark: SparkSession, path: str) -> None:
        out = io.BytesIO()
        np.savez_compressed(out, gains=self.gains, **vars(self.trees))
        spark.createDataFrame([(bytearray(out.getvalue()),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        saved = dict(np.load(io.BytesIO(bytes(spark.read.parquet(path).first()[0]))))
        gains = saved.pop("gains")
        return cls(FlatTrees(int(saved.pop("outputs")), **saved), gains)


def bin_edges(rows: DataFrame, vector: str, width: int, bins: int) -> list[np.ndarray]:
    """Upper edges of each feature's bins: some of its values, at most ``bins`` - 1, by a bounded sketch."""
    edges: list[np.ndarray] = []
    probs = [i / bins for i in range(1, bins)]
    array = rows.select(MF.vector_to_array(vector).alias("x"))
    for first in range(0, width, 64):
        asked = [F.percentile_approx(F.get("x", F.lit(i)), probs, F.lit(2000)).alias(f"e{i}") for i in range(first, min(width, first + 64))]
        for found in array.agg(*asked).first() or ():
            edges.append(np.unique(np.array(found if found is not None else [], float)))
    return edges


def store_blocks(rows: DataFrame, vector: str, label: str, weight: str | None, edges: list[np.ndarray], outputs: int) -> DataFrame:
    """Blocks of rows as bytes: labels, weights, bin numbers (feature by feature) and margins (output by output)."""
    given = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = rows.select(F.col(label).cast("int").alias("label"), given.alias("weight"), MF.vector_to_array(vector).alias("x")).filter("label is not null")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = math.ceil(batch.num_rows / max(1, math.ceil(batch.num_rows / BLOCK_ROWS)))
            for start in range(0, batch.num_rows, max(1, size)):
                part = batch.slice(start, size)
                values = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                bins = np.stack([np.searchsorted(e, values[:, i]) for i, e in enumerate(edges)]).astype(np.uint8)
                columns = [part.column(0).to_numpy().astype(np.int32), part.column(1).to_numpy().astype(float), bins, np.zeros((outputs, part.num_rows))]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=["labels", "weights", "bins", "margins"])

    return materialize(rows.mapInArrow(pack, BLOCKS), "boosting-blocks")


def dealt(blocks: DataFrame) -> tuple[DataFrame, int]:
    """The blocks dealt evenly in as many parts as there are cores, if there are enough of them, and the number of parts."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    numbered = blocks.rdd.zipWithIndex().map(lambda x: (x[1], x[0]))
    if numbered.getNumPartitions() != 1 and blocks.count() <= cores:
        return blocks, numbered.getNumPartitions()
    return blocks.sparkSession.createDataFrame(numbered.partitionBy(cores, lambda i: i % cores).values(), BLOCKS), cores


class Codes:
    """Columns of codes below ``CODES``: each stands for the bins of one feature or of several with few bins."""

    def __init__(self, counts: list[int]):
        self.counts, self.members = counts, []
        self.column, self.stride, widths = [0] * len(counts), [1] * len(counts), []
        for feature in sorted(range(len(counts)), key=lambda f: (-counts[f], f)):
            column = next((c for c, width in enumerate(widths) if width * counts[feature] <= CODES), len(widths))
            if column == len(widths):
                widths.append(1)
                self.members.append([])
            self.column[feature], self.stride[feature] = column, widths[column]
            self.members[column].append(feature)
            widths[column] *= counts[feature]
        self.widths = widths

    def pack(self, bins: np.ndarray) -> np.ndarray:
        """Codes (column, row) of bin numbers (feature, row)."""
        codes = np.zeros((len(self.widths), bins.shape[1]), np.uint8)
        for feature, column in enumerate(self.column):
            codes[column] += bins[feature] * np.uint8(self.stride[feature] % CODES)
        return codes

    def by_feature(self, sums: np.ndarray) -> np.ndarray:
        """(node, gradient or hessian, bins of all features) from (column, gradient or hessian, node, code)."""
        starts = np.cumsum([0, *self.counts])
        out = np.empty((sums.shape[2], 2, starts[-1]))
        for column, features in enumerate(self.members):
            # The last feature has the largest stride, so it is the first axis.
            shape = [self.counts[f] for f in reversed(features)]
            whole = sums[column, :, :, :self.widths[column]].reshape(2, -1, *shape)
            for place, feature in enumerate(reversed(features)):
                others = tuple(2 + i for i in range(len(features)) if i != place)
                out[:, :, starts[feature]:starts[feature + 1]] = whole.sum(axis=others).transpose(1, 0, 2)
        return out

    def tests(self, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Per node its column, whether each code goes right, and the left child; a leaf leads to itself."""
        feature = np.array(tree.feature)
        inner, left = feature >= 0, np.array(tree.left)
        stride, count = (np.array(x)[feature][:, None] for x in (self.stride, self.counts))
        right = np.arange(CODES) // stride % count > np.array(tree.bin)[:, None]
        right &= inner[:, None]
        return np.array(self.column)[feature] * inner, right.astype(np.uint8), np.where(inner, left, np.arange(len(left))), tree.depth()


def placed(codes: np.ndarray, tests: tuple[np.ndarray, np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The node that each row (a column of ``codes``) has come to."""
    column, right, left, depth = tests
    rows = codes.shape[1]
    if not depth or not rows:
        return np.zeros(rows, np.intp)
    at = left[0] + right[0].take(codes[column[0]])
    if depth > 1:
        lines, values, answers, first = np.arange(rows), codes.ravel(), right.ravel(), column * rows
        for _ in range(depth - 1):
            seen = first.take(at)
            seen += lines
            code = at * CODES
            code += values.take(seen)
            at = left.take(at)
            at += answers.take(code)
    return at


def advanced(codes: np.ndarray, margins: np.ndarray, known: Codes, trees: list[Tree]) -> np.ndarray:
    """Margins with the trees of a round added."""
    return np.stack([m + np.array(tree.value).take(placed(codes, known.tests(tree))) for m, tree in zip(margins, trees)])


@dataclass
class Pass:
    """What a task needs to know for one level."""

    outputs: int
    counts: list[int]
    bins: int
    recent: list[list[Tree]]
    growing: list[Tree]
    open: list[list[int]]

    def unpack(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        """Labels, weights, codes and margins of stored blocks, with the ``recent`` trees in their margins."""
        known = Codes(self.counts)
        for labels, weights, bins, margins in zip(*(batch.column(i).to_pylist() for i in range(4))):
            labels = np.frombuffer(labels, np.int32)
            codes = known.pack(np.frombuffer(bins, np.uint8).reshape(len(self.counts), len(labels)))
            margins = np.frombuffer(margins, float).reshape(self.outputs, len(labels))
            for trees in self.recent:
                margins = advanced(codes, margins, known, trees)
            yield labels, np.frombuffer(weights, float), codes, margins

    def gradients(self, labels: np.ndarray, weights: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.outputs == 1:
            p = 1 / (1 + np.exp(-margins))
            return (p - (labels == 1)) * weights, np.maximum(p * (1 - p), 1e-16) * weights
        odds = np.exp(margins - margins.max(axis=0))
        p = odds / odds.sum(axis=0)
        hit = np.arange(self.outputs)[:, None] == labels
        return (p - hit) * weights, np.maximum(2 * p * (1 - p), 1e-16) * weights

    def histograms(self, batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        """``sums`` of stored blocks."""
        return self.sums(together(block for batch in batches for block in self.unpack(batch)))

    def sums(self, blocks: Iterable[tuple[np.ndarray, ...]]) -> np.ndarray | None:
        """(open node, gradient or hessian, bins of all features) over blocks; the open nodes tree by tree."""
        known, total = Codes(self.counts), None
        tests = [known.tests(tree) if nodes else None for tree, nodes in zip(self.growing, self.open)]
        for labels, weights, codes, margins in blocks:
            total = np.zeros((len(known.widths), 2, sum(map(len, self.open)), CODES)) if total is None else total
            g, h = self.gradients(labels, weights, margins)
            root = codes.astype(np.intp) if sum(nodes == [0] for nodes in self.open) > 1 else None
            first = 0
            for output, nodes in enumerate(self.open):
                if not nodes:
                    continue
                here, pair = total[:, :, first:first + len(nodes)], (g[output], h[output])
                first += len(nodes)
                if nodes == [0]:
                    self.add(here, codes if root is None else root, None, None, pair)
                    continue
                number = np.full(len(self.growing[output].feature), -1)
                number[nodes] = np.arange(len(nodes))
                at = number.take(placed(codes, tests[output]))
                rows = np.flatnonzero(at >= 0)
                self.add(here, codes, rows, at.take(rows) * CODES, tuple(part.take(rows) for part in pair))
        return None if total is None else known.by_feature(total)

    def add(self, sums: np.ndarray, codes: np.ndarray, rows: np.ndarray | None, first: np.ndarray | None, pair: tuple[np.ndarray, np.ndarray]) -> None:
        """Adds rows to the sums (column, gradient or hessian, node, code) of their nodes, column by column."""
        for column, own in zip(codes, sums):
            cells = column if rows is None else first + column.take(rows)
            for part, target in zip(pair, own):
                target += np.bincount(cells, part, target.size).reshape(target.shape)


def together(blocks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The blocks, small ones joined."""
    held: list[tuple[np.ndarray, ...]] = []
    for block in blocks:
        if held and sum(len(b[0]) for b in held) + len(block[0]) > TOGETHER:
            yield tuple(np.concatenate(parts, axis=-1) for parts in zip(*held))
            held = []
        held.append(block)
    if held:
        yield tuple(np.concatenate(parts, axis=-1) for parts in zip(*held)) if len(held) > 1 else held[0]


@dataclass
class Search:
    """How a split is chosen from the sums of a node."""

    counts: list[int]
    bins: int
    l2: float
    least_weight: float

    def best(self, sums: np.ndarray) -> tuple[int, int, float, float, float, float, float]:
        """(feature, bin, gain, G, H, G left, H left); feature -1 where no split gains."""
        return self.all_best(sums[None])[0]

    def all_best(self, sums: np.ndarray) -> list[tuple[int, int, float, float, float, float, float]]:
        """``best`` of many nodes: (node, gradient or hessian, bins of all features)."""
        sums = sums.reshape(len(sums), 2, -1)
        starts = np.cumsum([0, *self.counts])
        whole, left = sums[:, :, :self.counts[0]].sum(axis=2), np.empty_like(sums)
        for first, last in zip(starts[:-1], starts[1:]):
            np.cumsum(sums[:, :, first:last], axis=2, out=left[:, :, first:last])
        g_left, h_left = left[:, 0], left[:, 1]
        g_all, h_all = whole[:, :1], whole[:, 1:]
        g_right, h_right = g_all - g_left, h_all - h_left
        gain = g_left**2 / (h_left + self.l2) + g_right**2 / (h_right + self.l2) - g_all**2 / (h_all + self.l2)
        usable = (h_left >= self.least_weight) & (h_right >= self.least_weight)
        usable[:, starts[1:] - 1] = False  # nothing is right of a feature's last bin
        gain = np.where(usable, gain, -np.inf)
        top = gain.max(axis=1)
        # Empty bins and features that part the rows alike gain the same, up to the order of additions.
        at = np.argmax(gain >= (top - ALIKE * np.abs(top))[:, None], axis=1)
        feature = np.searchsorted(starts, at, "right") - 1
        found = []
        for node, (cell, f) in enumerate(zip(at, feature)):
            own = float(g_all[node, 0]), float(h_all[node, 0])
            if top[node] > 1e-9:
                found.append((int(f), int(cell - starts[f]), float(gain[node, cell]), *own, float(g_left[node, cell]), float(h_left[node, cell])))
            else:
                found.append((-1, 0, 0.0, *own, 0.0, 0.0))
        return found


Key = tuple[int, int]


class Held:
    """Few blocks, in the memory of one process."""

    parts = 1

    def __init__(self, blocks: Iterable[tuple[np.ndarray, ...]], known: Codes):
        self.blocks, self.known = list(blocks), known

    def probe(self) -> np.ndarray:
        return np.concatenate([b[2] for b in self.blocks], axis=1) if self.blocks else np.zeros((len(self.known.widths), 0), np.uint8)

    def advance(self, trees: list[Tree]) -> None:
        self.blocks = [(labels, weights, codes, advanced(codes, margins, self.known, trees)) for labels, weights, codes, margins in self.blocks]

    def sums(self, todo: Pass) -> np.ndarray | None:
        return todo.sums(self.blocks)

    def close(self) -> None:
        pass


class Spread:
    """Blocks in the memory of the executors."""

    def __init__(self, blocks: DataFrame, parts: int, start: Pass):
        known = self.known = Codes(start.counts)
        self.parts, self.rounds, self.before = parts, 0, None
        self.context = blocks.sparkSession.sparkContext
        if self.context.getCheckpointDir() is None:
            self.context.setCheckpointDir(scratch_path(blocks.sparkSession, "boosting-margins"))

        def begin(rows: Iterator) -> Iterator[tuple[np.ndarray, ...]]:
            for row in rows:
                batch = pa.RecordBatch.from_arrays([pa.array([bytes(c)], pa.binary()) for c in row], names=["labels", "weights", "bins", "margins"])
                yield from start.unpack(batch)

        self.state = blocks.rdd.mapPartitions(lambda rows: together(begin(rows))).persist(StorageLevel.MEMORY_AND_DISK)

    def probe(self) -> np.ndarray:
        """Codes of some rows of every block."""
        blocks = max(1, self.state.count())
        each = max(1, PROBE // blocks)
        some = self.state.map(lambda b: b[2][:, ::max(1, b[2].shape[1] // each)].copy()).collect()
        return np.concatenate(some, axis=1) if some else np.zeros((len(self.known.widths), 0), np.uint8)

    def advance(self, trees: list[Tree]) -> None:
        known = self.known

        def add(blocks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
            for labels, weights, codes, margins in blocks:
                yield labels, weights, codes, advanced(codes, margins, known, trees)

        self.release()
        self.before, self.state = self.state, self.state.mapPartitions(add, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        self.rounds += 1
        if self.rounds % REFRESH == 0:
            self.state.checkpoint()

    def sums(self, todo: Pass) -> np.ndarray | None:
        """The histograms of all parts added up, on the driver if they are few."""
        keys, size = _keys(todo), 16 * sum(todo.counts)
        if self.parts * len(keys) * size <= DIRECT:
            total = None
            for one in self.state.mapPartitions(lambda blocks: [todo.sums(blocks)]).collect():
                if one is not None:
                    total = one.copy() if total is None else np.add(total, one, out=total)
        else:
            found = dict(self.merged(todo, keys).collect())
            total = np.stack([found[key] for key in keys]) if found else None
        self.release()
        return total

    def merged(self, todo: Pass, keys: list[Key]):
        """The histogram of each node, added up in groups, in two steps where there are many parts."""
        groups, steps = min(len(keys), self.context.defaultParallelism), math.ceil(self.parts / MERGED)

        def parts(index: int, blocks: Iterator) -> Iterator[tuple]:
            sums = todo.sums(blocks)
            if sums is not None:
                yield from (((key, index % steps), one) for key, one in zip(keys, sums))

        found = self.state.mapPartitionsWithIndex(parts)
        if steps > 1:
            found = found.reduceByKey(np.add, groups)
        return found.map(lambda x: (x[0][0], x[1])).reduceByKey(np.add, groups)

    def splits(self, todo: Pass, search: Search) -> dict[Key, tuple]:
        """Only the best split of each node leaves the executors."""
        found = dict(self.merged(todo, _keys(todo)).mapValues(search.best).collect())
        self.release()
        return found

    def release(self) -> None:
        if self.before is not None:
            self.before.unpersist()
            self.before = None

    def close(self) -> None:
        self.release()
        self.state.unpersist()


def _keys(todo: Pass) -> list[Key]:
    return [(output, node) for output, open_ in enumerate(todo.open) for node in open_]


@dataclass
class Level:
    """Histograms of a level's parents, and which of their children are added up."""

    rows: Held | Spread
    known: Codes
    search: Search
    probe: np.ndarray
    parents: dict[Key, np.ndarray] = field(default_factory=dict)

    def splits(self, todo: Pass) -> dict[Key, tuple]:
        """The best split of each open node (tree, node)."""
        keys = _keys(todo)
        if isinstance(self.rows, Spread) and len(keys) * 16 * sum(todo.counts) > DIRECT:
            self.parents = {}
            return self.rows.splits(todo, self.search)
        fewer = [self.fewer(tree, nodes, output) for output, (tree, nodes) in enumerate(zip(todo.growing, todo.open))]
        part = Pass(todo.outputs, todo.counts, todo.bins, todo.recent, todo.growing, fewer)
        sums = self.rows.sums(part)
        if sums is None:
            return {}
        found = dict(zip(_keys(part), sums))
        for output, (tree, nodes) in enumerate(zip(todo.growing, todo.open)):
            for pair in zip(nodes[::2], nodes[1::2]):
                for node, sibling in (pair, pair[::-1]):
                    if (output, node) not in found:
                        found[output, node] = self.parents[output, tree.left.index(pair[0])] - found[output, sibling]
        self.parents = found
        return dict(zip(keys, self.search.all_best(np.stack([found[key] for key in keys])))) if keys else {}

    def fewer(self, tree: Tree, nodes: list[int], output: int) -> list[int]:
        """Of each two siblings the one that probably has fewer rows; all nodes where the parents are not known."""
        if not nodes or nodes == [0] or any((output, tree.left.index(left)) not in self.parents for left in nodes[::2]):
            return nodes
        counts = np.bincount(placed(self.probe, self.known.tests(tree)), minlength=len(tree.feature))
        return [left if counts[left] <= counts[left + 1] else left + 1 for left in nodes[::2]]


def grow(level: Level, outputs: int, depth: int, rate: float, gains: np.ndarray) -> list[Tree]:
    """One round: a tree per output."""
    search = level.search
    trees, open_ = [Tree() for _ in range(outputs)], [[0] for _ in range(outputs)]
    pay = lambda g, h: -rate * g / (h + search.l2)
    level.parents = {}
    for _ in range(depth):
        splits = level.splits(Pass(outputs, search.counts, search.bins, [], trees, open_))
        open_ = [[] for _ in range(outputs)]
        for (output, node), (feature, bin_, gain, g, h, g_left, h_left) in sorted(splits.items()):
            tree = trees[output]
            if node == 0:
                tree.value[0], tree.cover[0] = pay(g, h), h
            if feature >= 0:
                left = len(tree.feature)
                tree.split(node, feature, bin_, (pay(g_left, h_left), h_left), (pay(g - g_left, h - h_left), h - h_left))
                gains[feature] += gain
                open_[output] += [left, left + 1]
        if not any(open_):
            break
    return trees


def boosted(rows: Held | Spread, search: Search, outputs: int, rounds: int, depth: int, rate: float) -> tuple[list[list[Tree]], np.ndarray]:
    """All rounds, and the gain of each feature."""
    done, gains = [], np.zeros(len(search.counts))
    try:
        level = Level(rows, Codes(search.counts), search, rows.probe())
        for _ in range(rounds):
            if done:
                rows.advance(done[-1])
            done.append(grow(level, outputs, depth, rate, gains))
    finally:
        rows.close()
    return done, gains


def flat(rounds: list[list[Tree]], edges: list[np.ndarray], outputs: int) -> FlatTrees:
    trees = [(output, tree) for trees in rounds for output, tree in enumerate(trees)]
    start = np.cumsum([0, *(len(t.feature) for _, t in trees)])
    feature = np.array([f for _, t in trees for f in t.feature], np.int64)
    left = np.array([n + b if n >= 0 else -1 for (_, t), b in zip(trees, start) for n in t.left], np.int64)
    at = np.array([b for _, t in trees for b in t.bin], np.int64)
    cut = np.array([edges[f][b] if f >= 0 else 0.0 for f, b in zip(feature, at)])
    leaf = feature < 0
    output = np.repeat([o for o, _ in trees], np.diff(start)) if trees else np.zeros(0, np.int64)
    value = np.array([v for _, t in trees for v in t.value])
    return FlatTrees(
        outputs, start, feature, cut, left, np.where(left >= 0, left + 1, -1), np.array([c for _, t in trees for c in t.cover]),
        np.concatenate([[0], np.cumsum(leaf)]), output[leaf].astype(np.int64), value[leaf],
    )


def fit(
    rows: DataFrame, vector: str, label: str, classes: int, weight: str | None = None, rounds: int = 200, depth: int = 6,
    rate: float = 0.1, bins: int = BINS, l2: float = 1.0, least_weight: float = 1.0,
) -> BoostedModel:
    """A model of ``rounds`` trees per class (one per round for two classes) on a vector column and class numbers."""
    if not 2 <= bins <= 256:
        raise ValueError("bins are kept in bytes: 2 to 256 of them")
    outputs = classes if classes > 2 else 1
    first = rows.first()
    width = 0 if first is None else int(first[vector].size)
    edges = bin_edges(rows, vector, width, bins)
    counts = [len(e) + 1 for e in edges]
    search, start = Search(counts, bins, l2, least_weight), Pass(outputs, counts, bins, [], [], [])
    if not width or not rounds:
        return BoostedModel(flat([], edges, outputs), np.zeros(width))
    blocks = store_blocks(rows, vector, label, weight, edges, outputs)
    total = blocks.agg(F.coalesce(F.sum(F.length("labels")), F.lit(0))).first()[0] // 4
    if not total:
        done, gains = boosted(Held([], Codes(counts)), search, outputs, rounds, depth, rate)
    elif total <= LOCAL:

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = Held(together(block for batch in batches for block in start.unpack(batch)), Codes(counts))
            yield pa.RecordBatch.from_pydict({"found": [pickle.dumps(boosted(held, search, outputs, rounds, depth, rate))]})

        found = blocks.coalesce(1).mapInArrow(whole, "found binary").collect()
        done, gains = pickle.loads(found[0][0])
    else:
        blocks, parts = dealt(blocks)
        done, gains = boosted(Spread(blocks, parts, start), search, outputs, rounds, depth, rate)
    return BoostedModel(flat(done, edges, outputs), gains)
