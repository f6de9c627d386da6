"""Exact order statistics of many columns without sorting them.

A bounded sample gives edges for each column. One pass counts, inside the tasks, how many
values fall on each edge and between each two; equal values that are frequent are edges
and so need no more than their count. The counts say between which edges a wanted rank lies, or a
distance between two tables may be largest or change its sign. Only the values there are
gathered, counted once per distinct value and sorted, between two edges at a time. Where too many would come
together, the stretch gets edges of its own first and the pass is repeated.

Rows are never exploded and no table of values is stored. What reaches the driver is the
edges and their counts: columns x cells, whatever the table's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowlake.functions.scalar import quoted

EDGES = 256
#: Rows of a side that the edges come from, about; values between two edges that are sorted in one go.
SAMPLED = 100_000
TOGETHER = 4_000_000


def numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles ``c0``, ``c1``, ...; NaN is null."""
    value = lambda c: quoted(c).cast("double")
    return df.select(*[F.when(~F.isnan(value(c)), value(c)).alias(f"c{i}") for i, c in enumerate(columns)])


def some(df: DataFrame, rows: int) -> DataFrame:
    return df if rows <= SAMPLED else df.sample(SAMPLED / rows, seed=7)


def sampled_edges(sides: list[DataFrame], rows: list[int], width: int, count: int) -> list[np.ndarray]:
    """Some values of each column, evenly spread over a sample of all sides."""
    both = some(sides[0], rows[0])
    for side, n in zip(sides[1:], rows[1:]):
        both = both.unionAll(some(side, n))
    probs, found = [i / count for i in range(count + 1)], []
    for first in range(0, width, 64):
        asked = [F.percentile_approx(f"c{i}", probs, F.lit(10 * count)).alias(f"c{i}") for i in range(first, min(width, first + 64))]
        found += list(both.agg(*asked).first())
    return [np.unique(np.array([] if e is None else e, float)) for e in found]


def cell_of(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """2 i + 1 for a value that is edge i, 2 i for one below edge i and above the edge before."""
    left = np.searchsorted(edges, values, "left")
    return left * 2 + (np.searchsorted(edges, values, "right") > left)


def columns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        yield [c.drop_null().to_numpy(zero_copy_only=False) for c in batch.columns]


def cells(df: DataFrame, edges: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per column and cell: the number of values, and the sum of their distances above the edge below."""
    sent = df.sparkSession.sparkContext.broadcast(edges)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        n, above = [np.zeros(2 * len(e) + 1, np.int64) for e in known], [np.zeros(2 * len(e) + 1) for e in known]
        for columns in columns_of(batches):
            for i, (values, e) in enumerate(zip(columns, known)):
                cell = cell_of(values, e)
                n[i] += np.bincount(cell, minlength=len(n[i]))
                if len(e):
                    # The outermost cells hold what the sample has not seen; they lean on the nearest edge.
                    base = e[np.clip((cell - 1) // 2, 0, len(e) - 1)]
                    above[i] += np.bincount(cell, values - base, len(n[i]))
        for i, counts in enumerate(n):
            at = np.flatnonzero(counts)
            if len(at):
                yield pa.RecordBatch.from_pydict({"i": pa.array(np.full(len(at), i, np.int32)), "cell": pa.array(at.astype(np.int32)), "n": counts[at], "above": above[i][at]})

    found = df.mapInArrow(count, "i int, cell int, n bigint, above double").groupBy("i", "cell").agg(F.sum("n").alias("n"), F.sum("above").alias("above"))
    n, above = [np.zeros(2 * len(e) + 1, np.int64) for e in edges], [np.zeros(2 * len(e) + 1) for e in edges]
    for row in found.collect():
        n[row["i"]][row["cell"]], above[row["i"]][row["cell"]] = row["n"], row["above"]
    return n, above


def values_in(df: DataFrame, edges: list[np.ndarray], wanted: list[np.ndarray], side: str) -> DataFrame:
    """(i, cell, value, n) for the values in the wanted cells of each column, counted inside the tasks first."""
    sent = df.sparkSession.sparkContext.broadcast((edges, wanted))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cells_ = sent.value
        for columns in columns_of(batches):
            for i, values in enumerate(columns):
                if not len(cells_[i]):
                    continue
                cell = cell_of(values, known[i])
                mine = np.isin(cell, cells_[i])
                if mine.any():
                    value, n = np.unique(values[mine], return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "i": pa.array(np.full(len(value), i, np.int32)), "cell": pa.array(cell_of(value, known[i]).astype(np.int32)), "value": value, "n": n.astype(np.int64),
                    })

    found = df.mapInArrow(pick, "i int, cell int, value double, n bigint")
    return found.withColumn("side", F.lit(side))


def finer(sides: list[DataFrame], edges: list[np.ndarray], wanted: list[np.ndarray]) -> list[np.ndarray]:
    """The edges with more of them inside the wanted cells."""
    found = None
    for side in sides:
        part = values_in(side, edges, wanted, "")
        found = part if found is None else found.unionAll(part)
    inside = found.groupBy("i", "cell").agg(F.percentile_approx("value", [k / EDGES for k in range(EDGES + 1)], F.lit(10 * EDGES)).alias("e"))
    out = list(edges)
    for row in inside.collect():
        out[row["i"]] = np.union1d(out[row["i"]], np.array(row["e"], float))
    return out


@dataclass
class Column:
    """What is known of one column: cells of both sides, and what its wanted cells say."""

    edges: np.ndarray
    n: np.ndarray
    m: np.ndarray
    above_n: np.ndarray
    above_m: np.ndarray
    ranks: list[int]
    values: dict[int, float] = field(default_factory=dict)
    gap: float = 0.0
    area: float = 0.0

    def __post_init__(self) -> None:
        self.total_n, self.total_m = int(self.n.sum()), int(self.m.sum())
        self.before_n, self.before_m = np.cumsum(self.n) - self.n, np.cumsum(self.m) - self.m

    @property
    def both(self) -> bool:
        return self.total_n > 0 and self.total_m > 0

    def inner(self) -> np.ndarray:
        """Cells between edges that hold values."""
        at = np.arange(0, len(self.n), 2)
        return at[(self.n[at] + self.m[at]) > 0]

    def settle(self) -> np.ndarray:
        """Takes from the counts what they decide, and returns the cells whose values must be seen."""
        wanted = set()
        ends = np.cumsum(self.n)
        for rank in self.ranks:
            cell = int(np.searchsorted(ends, rank, "right"))
            if cell % 2:
                self.values[rank] = float(self.edges[cell // 2])
            else:
                wanted.add(cell)
        if not self.both or not len(self.m):
            return np.array(sorted(wanted), np.int64)
        low_n, low_m = self.before_n / self.total_n, self.before_m / self.total_m
        high_n, high_m = (self.before_n + self.n) / self.total_n, (self.before_m + self.m) / self.total_m
        self.gap = float(np.abs(high_n - high_m).max(initial=0.0))
        inner = self.inner()
        reach = np.maximum(high_n - low_m, high_m - low_n)[inner]
        wanted.update(inner[reach > self.gap].tolist())
        # The difference keeps its sign in a cell where one side is never below the other.
        turns = inner[~((low_n >= high_m) | (low_m >= high_n))[inner]]
        outer = {0, len(self.n) - 1} & set(inner.tolist())
        wanted.update(turns.tolist(), outer)
        self.area = self._area(wanted, low_n, low_m)
        return np.array(sorted(wanted), np.int64)

    def _area(self, but: set[int], low_n: np.ndarray, low_m: np.ndarray) -> float:
        """The area between the two distribution functions over all cells but the given ones."""
        total = 0.0
        for cell in range(2, len(self.n) - 1, 2):
            if cell in but:
                continue
            a, b = self.edges[cell // 2 - 1], self.edges[cell // 2]
            # Each value lifts its function from itself to the cell's end.
            n = (self.n[cell] * (b - a) - self.above_n[cell]) / self.total_n
            m = (self.m[cell] * (b - a) - self.above_m[cell]) / self.total_m
            total += abs((low_n[cell] - low_m[cell]) * (b - a) + n - m)
        return float(total)

    def look(self, cell: int, values: np.ndarray, n: np.ndarray, m: np.ndarray) -> None:
        """Takes what the sorted values of a cell say."""
        start = int(self.before_n[cell])
        ends = start + np.cumsum(n)
        for rank in self.ranks:
            if start <= rank < start + int(n.sum()):
                self.values[rank] = float(values[np.searchsorted(ends, rank, "right")])
        if not self.both:
            return
        differ = ends / self.total_n - (self.before_m[cell] + np.cumsum(m)) / self.total_m
        self.gap = max(self.gap, float(np.abs(differ).max()))
        k = cell // 2
        first = self.edges[k - 1] if k > 0 else values[0]
        last = self.edges[k] if k < len(self.edges) else values[-1]
        before = self.before_n[cell] / self.total_n - self.before_m[cell] / self.total_m
        points = np.concatenate([[first], values, [last]])
        self.area += float((np.abs(np.concatenate([[before], differ])) * np.diff(points)).sum())


def quantile_ranks(total: int, probs: list[float]) -> list[int]:
    """Ranks from 0 that linear interpolation looks at."""
    places = [p * (total - 1) for p in probs] if total else []
    return sorted({f(p) for p in places for f in (math.floor, math.ceil)})


def interpolated(column: Column, probs: list[float]) -> list[float | None]:
    out = []
    for p in probs:
        place = p * (column.total_n - 1)
        low, high = (column.values[f(place)] for f in (math.floor, math.ceil)) if column.total_n else (None, None)
        out.append(None if low is None else low + (high - low) * (place - math.floor(place)))
    return out


def examine(first: DataFrame, second: DataFrame | None, columns: list[str], probs: list[float]) -> list[Column]:
    """Ranks of the first table's columns, and gap and area between the distributions of both tables."""
    sides = [numbers(side, columns) for side in (first, second) if side is not None]
    edges = sampled_edges(sides, [side.count() for side in sides], len(columns), EDGES)
    while True:
        counted = [cells(side, edges) for side in sides]
        known, wanted, crowded = [], [], []
        for i, e in enumerate(edges):
            n, above_n = counted[0][0][i], counted[0][1][i]
            m, above_m = (counted[1][0][i], counted[1][1][i]) if len(sides) > 1 else (np.zeros_like(n), np.zeros_like(above_n))
            column = Column(e, n, m, above_n, above_m, quantile_ranks(int(n.sum()), probs))
            need = column.settle()
            known.append(column)
            wanted.append(need)
            crowded.append(need[(n + m)[need] > TOGETHER])
        if not any(map(len, crowded)):
            break
        edges = finer(sides, edges, crowded)
    if any(map(len, wanted)):
        parts = [values_in(side, edges, wanted, name) for side, name in zip(sides, "nm")]
        found = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
        count = lambda name: F.sum(F.when(F.col("side") == name, F.col("n")).otherwise(0)).alias(name)
        found = found.groupBy("i", "cell", "value").agg(count("n"), count("m"))
        sent = sides[0].sparkSession.sparkContext.broadcast(known)

        def look(table: pa.Table) -> pa.Table:
            table = table.sort_by("value")
            i, cell = table["i"][0].as_py(), table["cell"][0].as_py()
            column = sent.value[i]
            one = Column(column.edges, column.n, column.m, column.above_n, column.above_m, column.ranks)
            one.look(cell, *(table[c].to_numpy() for c in ("value", "n", "m")))
            return pa.table({"i": pa.array([i], pa.int32()), "gap": [one.gap], "area": [one.area], "ranks": pa.array([list(one.values)], pa.list_(pa.int64())), "values": pa.array([list(one.values.values())], pa.list_(pa.float64()))})

        for row in found.groupBy("i", "cell").applyInArrow(look, "i int, gap double, area double, ranks array<bigint>, values array<double>").collect():
            column = known[row["i"]]
            column.gap, column.area = max(column.gap, row["gap"]), column.area + row["area"]
            column.values.update(zip(row["ranks"], row["values"]))
    return known


def bin_counts(df: DataFrame, columns: list[str], edges: list[np.ndarray]) -> list[np.ndarray]:
    """How many values of each column fall into bins that hold their lower edge, the last one also its upper edge."""
    counts, _ = cells(numbers(df, columns), edges)
    out = []
    for n in counts:
        inside = n[1:-1]
        bins = inside[0:-1:2] + inside[1::2] if len(inside) > 1 else np.zeros(0, np.int64)
        if len(bins):
            bins = bins.copy()
            bins[-1] += inside[-1]
        out.append(bins)
    return out
