"""Multinomial logistic regression, trained by passes over stored blocks of rows.

The loss, its scaling and the search are those of Spark's ``LogisticRegression`` (L-BFGS with ten
corrections and a strong Wolfe line search, from the logarithms of the class weights), so the fit
stops at the same place. What differs is a pass over the rows:

* rows are stored once as blocks, feature by feature, each in the smallest type that holds its
  values exactly, so they stay in memory where vectors of doubles do not;
* blocks are standardised where they are read, and margins and gradient are matrix products;
* the blocks are dealt evenly over the session's cores, however few files the rows came in. A task
  sends one sum, whatever its rows, and the driver keeps the coefficients only.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import functions as MF
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.operators.forest import checked
from flowlake.session import materialize

#: Values of a block, and blocks that a task reads, at most.
BLOCK_CELLS = 1 << 17
BLOCKS_PER_TASK = 256
#: Corrections and function values that the search remembers, and steps of a line search.
CORRECTIONS, VALUES, TRIES = 10, 20, 10
BLOCKS = "rows int, labels binary, weights binary, kinds binary, cells binary"
#: From wide to narrow, so that all cells are aligned.
KINDS = (np.float64, np.float32, np.int32, np.int16, np.int8)


@dataclass
class LogisticModel:
    """Coefficients (class, feature) and intercepts; the softmax of the margins is the probability."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    #: Loss at the start and after each step.
    losses: np.ndarray

    @property
    def coefficientMatrix(self) -> DenseMatrix:
        return DenseMatrix(*self.coefficients.shape, self.coefficients.ravel(order="F"))

    @property
    def interceptVector(self) -> DenseVector:
        return DenseVector(self.intercepts)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``rawPrediction`` and ``probability`` as vectors for a vector column ``features``."""
        coefficients, intercepts = self.coefficients, self.intercepts
        sure = np.flatnonzero(np.isinf(intercepts))

        @F.arrow_udf("struct<raw:array<double>,p:array<double>>")
        def answers(vectors: pa.Array) -> pa.Array:
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), coefficients.shape[1])
            raw = x @ coefficients.T + intercepts
            if len(sure):
                p = np.zeros_like(raw)
                p[:, sure] = 1.0
            else:
                p = np.exp(raw - raw.max(axis=1, keepdims=True, initial=-np.inf))
                p /= p.sum(axis=1, keepdims=True)
            starts = np.arange(0, raw.size + 1, raw.shape[1], dtype=np.int32)
            return pa.StructArray.from_arrays([pa.ListArray.from_arrays(starts, part.ravel()) for part in (raw, p)], ["raw", "p"])

        scored = rows.withColumn("__answer", answers(MF.vector_to_array("features")))
        return scored.withColumns(
            {"rawPrediction": MF.array_to_vector("__answer.raw"), "probability": MF.array_to_vector("__answer.p")}
        ).drop("__answer")

    def save(self, spark: SparkSession, path: str) -> None:
        out = io.BytesIO()
        np.savez_compressed(out, **vars(self))
        spark.createDataFrame([(bytearray(out.getvalue()),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LogisticModel:
        return cls(**np.load(io.BytesIO(bytes(spark.read.parquet(path).first()[0]))))


# ---- blocks ------------------------------------------------------------------


def packed(values: np.ndarray) -> tuple[bytes, bytes]:
    """The kind of each line, and the cells of all lines in their kinds, the wide ones first."""
    kinds = np.zeros(len(values), np.uint8)
    for i, line in enumerate(values):
        low, high = line.min(initial=0), line.max(initial=0)
        for code in range(len(KINDS) - 1, 0, -1):
            kind = KINDS[code]
            limits = np.finfo(kind) if code == 1 else np.iinfo(kind)
            if limits.min <= low and high <= limits.max and (line.astype(kind) == line).all():
                kinds[i] = code
                break
    return kinds.tobytes(), b"".join(values[kinds == code].astype(kind).tobytes() for code, kind in enumerate(KINDS))


def unpacked(kinds: bytes, cells: bytes, rows: int) -> np.ndarray:
    """The lines as doubles."""
    kinds = np.frombuffer(kinds, np.uint8)
    values, place = np.empty((len(kinds), rows)), 0
    for code, kind in enumerate(KINDS):
        lines = np.flatnonzero(kinds == code)
        if len(lines) and rows:
            values[lines] = np.frombuffer(cells, kind, len(lines) * rows, place).reshape(len(lines), rows)
            place += len(lines) * rows * np.dtype(kind).itemsize
    return values


def store_blocks(rows: DataFrame, vector: str, label: str, weight: str | None, width: int) -> DataFrame:
    """Blocks of rows as bytes: labels, weights and values, feature by feature, dealt evenly."""
    given = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = rows.select(F.col(label).cast("int").alias("label"), given.alias("weight"), MF.vector_to_array(vector).alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = max(1, BLOCK_CELLS // max(1, width))
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                values = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)
                kinds, cells = packed(np.ascontiguousarray(values.T))
                columns = [part.column(0).to_numpy().astype(np.int32).tobytes(), part.column(1).to_numpy().astype(float).tobytes(), kinds, cells]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), *[pa.array([c], pa.binary()) for c in columns]],
                    names=["rows", "labels", "weights", "kinds", "cells"],
                )

    stored = materialize(rows.mapInArrow(pack, BLOCKS), "logistic-blocks")
    cores = stored.sparkSession.sparkContext.defaultParallelism
    waves = math.ceil(stored.count() / (cores * BLOCKS_PER_TASK))
    return stored.repartition(cores * max(1, waves))


def added(blocks: DataFrame, add: Callable[[np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]], merge: list[np.ufunc]) -> list[np.ndarray] | None:
    """What ``add`` finds in (labels, weights, values) of each block, merged over all blocks; None without any."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] | None = None
        for batch in batches:
            for n, labels, weights, kinds, cells in zip(*(c.to_pylist() for c in batch.columns)):
                one = add(np.frombuffer(labels, np.int32), np.frombuffer(weights, float), unpacked(kinds, cells, n))
                found = one if found is None else [how(a, b) for how, a, b in zip(merge, found, one)]
        if found is not None:
            yield pa.RecordBatch.from_pydict({"found": [[np.asarray(a, float).tobytes() for a in found]]})

    total: list[np.ndarray] | None = None
    for row in blocks.mapInArrow(of_task, "found array<binary>").collect():
        one = [np.frombuffer(bytes(a)) for a in row["found"]]
        total = one if total is None else [how(a, b) for how, a, b in zip(merge, total, one)]
    return total


# ---- search ------------------------------------------------------------------


class SearchFailed(Exception):
    """A direction or a step length that cannot be used."""


def direction(gradient: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    """The two-loop recursion; ``steps`` and changes of the gradient are given newest first."""
    found, shares = -gradient, []
    for step, change in zip(steps, changes):
        shares.append(step @ found / (step @ change))
        found = found - shares[-1] * change
    if steps:
        along = steps[0] @ changes[0]
        if not along >= 0 or np.isnan(shares).any():
            raise SearchFailed
        found = found * (along / (changes[0] @ changes[0]))
    for step, change, share in reversed(list(zip(steps, changes, shares))):
        found = found + (share - change @ found / (step @ change)) * step
    return found


def between(left: tuple, right: tuple) -> float:
    """The lowest point of the cubic through two (place, value, slope), not too near to either."""
    (t0, f0, s0), (t1, f1, s1) = (left, right) if left[0] <= right[0] else (right, left)
    d1 = s0 + s1 - 3 * (f0 - f1) / (t0 - t1)
    d2 = np.sqrt(d1 * d1 - s0 * s1)
    t = t1 - (t1 - t0) * (s1 + d2 - d1) / (s1 - s0 + 2 * d2)
    low, high = t0 + 0.1 * (t1 - t0), t0 + 0.9 * (t1 - t0)
    return low if t < low else high if t > high else t


def step_length(along: Callable[[float], tuple], start: tuple, t: float) -> float:
    """A length that meets the strong Wolfe conditions; ``along`` gives (place, value, slope)."""
    _, value, slope = low = start
    if slope > 0:
        raise SearchFailed
    high = None
    for i in range(TRIES):
        here = along(t)
        if not np.isfinite(here[1]):
            t /= 2.0
            continue
        if here[1] > value + 1e-4 * t * slope or (here[1] >= low[1] and i > 0):
            high = here
            break
        if abs(here[2]) <= 0.9 * abs(slope):
            return t
        if here[2] >= 0:
            low, high = here, low
            break
        low, t = here, t * 1.5
    if high is None:
        raise SearchFailed
    for _ in range(TRIES):
        here = along(between(low, high))
        if here[1] > value + 1e-4 * here[0] * slope or here[1] >= low[1]:
            high = here
            continue
        if abs(here[2]) <= 0.9 * abs(slope):
            return here[0]
        if here[2] * (high[0] - low[0]) >= 0:
            high = low
        low = here
    raise SearchFailed


def minimised(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, iterations: int, tolerance: float) -> tuple[np.ndarray, list[float]]:
    """The place where the search stops, and the value at the start and after each step.

    It stops after ``iterations``, where the last ``VALUES`` values differ by less than
    ``tolerance`` of the first, where the gradient is smaller than that part of the value, or
    where no step can be found even without memory.
    """
    value, gradient = objective(x)
    values, recent, failed = [value], [math.inf], False
    steps: list[np.ndarray] = []
    changes: list[np.ndarray] = []
    while len(values) <= iterations:
        settled = len(recent) > 1 and abs(value - max(recent)) <= tolerance * values[0]
        if settled or np.linalg.norm(gradient) <= max(tolerance * value, 1e-8):
            break
        seen: dict[float, tuple[float, np.ndarray]] = {}
        try:
            with np.errstate(all="ignore"):
                to = direction(gradient, steps, changes)

                def along(t: float) -> tuple:
                    seen[t] = objective(x + to * t)
                    return t, seen[t][0], seen[t][1] @ to

                t = step_length(along, (0.0, value, gradient @ to), 1.0 / np.linalg.norm(to) if len(values) == 1 else 1.0)
                if t * np.linalg.norm(gradient) < 1e-10:
                    raise SearchFailed
        except SearchFailed:
            if failed:
                break
            steps, changes, failed = [], [], True
            continue
        failed, before = False, gradient
        step = to * t
        new = x + step
        value, gradient = seen[t]
        steps, changes = [new - x, *steps][:CORRECTIONS], [gradient - before, *changes][:CORRECTIONS]
        x = new
        values.append(value)
        recent = [*recent, value][-VALUES:]
    return x, values


# ---- fit ---------------------------------------------------------------------


def fit(
    rows: DataFrame, vector: str, label: str, weight: str | None, means: np.ndarray, spread: np.ndarray,
    strength: float = 1.0, iterations: int = 1000, tolerance: float = 1e-4,
) -> LogisticModel:
    """A model on the vector column less ``means`` and by ``spread``; ``strength`` divides the penalty of the summed loss."""
    unit = np.divide(1.0, spread, out=np.zeros(len(spread)), where=spread != 0)
    # The stored blocks are read once per step.
    blocks = store_blocks(checked(rows, vector, label, weight), vector, label, weight, len(means)).persist()
    try:
        return _fitted(blocks, means, unit, strength, iterations, tolerance)
    finally:
        blocks.unpersist()


def _fitted(blocks: DataFrame, means: np.ndarray, unit: np.ndarray, strength: float, iterations: int, tolerance: float) -> LogisticModel:
    width = len(means)
    top = blocks.select(F.col("labels")).mapInArrow(_largest, "top int").agg(F.max("top")).first()[0]
    if top is None:
        raise ValueError("there are no rows to train on")
    classes = top + 1

    def describe(labels: np.ndarray, w: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        x = (x - means[:, None]) * unit[:, None]
        some = w > 0
        return [
            np.bincount(labels, w, classes), np.array([w @ w]), x @ w, (x * x) @ w,
            x[:, some].min(axis=1, initial=np.inf), x[:, some].max(axis=1, initial=-np.inf),
        ]

    found = added(blocks, describe, [np.add] * 4 + [np.minimum, np.maximum])
    by_class, squares, sums, of_squares, low, high = found
    total = float(by_class.sum())
    if not total > 0:
        raise ValueError("the rows to train on have no weight")
    # Classes behind the last one with weight have no coefficients.
    classes = int(np.flatnonzero(by_class)[-1]) + 1
    by_class = by_class[:classes]
    if np.count_nonzero(by_class) == 1:
        return LogisticModel(np.zeros((classes, width)), np.where(by_class > 0, np.inf, 0.0), np.zeros(0))
    centre = sums / total
    freedom = total - float(squares[0]) / total
    deviation = np.sqrt(np.maximum(of_squares - total * centre * centre, 0.0) / freedom) if freedom > 0 else np.zeros(width)
    deviation[low >= high] = 0.0
    scale = np.divide(1.0, deviation, out=np.zeros(width), where=deviation > 0)
    # Standardised twice: by the scaler and, with the weights, for the search.
    shift = means + np.divide(centre, unit, out=np.zeros(width), where=unit > 0)
    factor = unit * scale
    penalty = scale * scale / (strength * total)

    def objective(flat: np.ndarray) -> tuple[float, np.ndarray]:
        weights = flat.reshape(classes, width + 1)
        inner, offset = weights[:, :-1], weights[:, -1:]
        units = np.ascontiguousarray(inner * factor)

        def add(labels: np.ndarray, w: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
            x -= shift[:, None]
            known = labels < classes
            y, at = np.where(known, labels, 0), np.arange(len(labels))
            margins = units @ x + offset
            margins -= margins.max(axis=0)
            own = margins[y, at]
            np.exp(margins, out=margins)
            sums = margins.sum(axis=0)
            margins *= w / sums
            margins[y, at] -= w
            return [np.array([w @ (np.log(sums) - own)]), np.concatenate([margins @ x.T, margins.sum(axis=1, keepdims=True)], axis=1).ravel()]

        loss, slope = added(blocks, add, [np.add, np.add])
        gradient = slope.reshape(classes, width + 1) / total
        gradient[:, :-1] = gradient[:, :-1] * factor + penalty * inner
        return float(loss[0]) / total + 0.5 * float((penalty * inner * inner).sum()), gradient.ravel()

    start = np.zeros((classes, width + 1))
    start[:, -1] = np.log1p(by_class) - np.log1p(by_class).mean()
    place, losses = minimised(objective, start.ravel(), iterations, tolerance)
    place = place.reshape(classes, width + 1)
    coefficients = place[:, :-1] * scale
    intercepts = place[:, -1] - coefficients @ centre
    return LogisticModel(coefficients, intercepts - intercepts.mean(), np.array(losses))


def _largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tops = [int(np.frombuffer(labels, np.int32).max()) for labels in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_pydict({"top": pa.array(tops, pa.int32())})
