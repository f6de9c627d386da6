"""What a Python worker keeps between batches and tasks, and rows sent on in slices.

Spark hands its Python workers on from stage to stage, all of them in turn. A worker keeps
the things of one operator at a time: when another operator begins, what was kept goes and its
memory is given back. Tables that grow with the words they meet are bounded in bytes.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

#: Bytes of remembered words of one kind, about; rows that are worked on and sent on together.
MEMORY_BYTES = 16_000_000
SLICE = 256
#: Bytes of rows that Spark hands to a worker at once, where the session does not say.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
#: An entry of a table, besides the key's and value's own bytes.
ENTRY = 100


class _Shelf:
    owner: str | None = None
    things: dict[Callable, tuple[Any, Any]] = {}


def begin(owner: str) -> None:
    """What other operators keep in this worker goes."""
    if _Shelf.owner == owner:
        return
    had = bool(_Shelf.things)
    _Shelf.owner, _Shelf.things = owner, {}
    if had:
        give_back()


def give_back() -> None:
    """Memory that is free in this process goes back to the system: at the end of a task, as idle workers stay."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Long texts come in batches of bounded size; a session's own setting stays."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def kept(owner: str, make: Callable, content: Any = None) -> Any:
    """``make(content)``, made once while ``owner`` works here with this content."""
    begin(owner)
    found = _Shelf.things.get(make)
    if found is None or found[0] is not content and found[0] != content:
        _Shelf.things.pop(make, None)
        found = _Shelf.things[make] = (content, make(content) if content is not None else make())
    return found[1]


class Memory(dict):
    """A table that is emptied before it would hold more than ``most`` bytes."""

    def __init__(self, most: int = MEMORY_BYTES):
        super().__init__()
        self.most, self.size = most, 0

    def clear(self) -> None:
        super().clear()
        self.size = 0

    def grow(self, *things: Any) -> None:
        """Count an entry of these things."""
        self.size += ENTRY + sum(map(sys.getsizeof, things))

    @property
    def full(self) -> bool:
        return self.size > self.most


def with_columns(rows: DataFrame, fields: list[tuple[str, DataType]], make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], drop: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with the columns that the function given by ``make()`` finds for a slice of rows.

    Rows travel once, with all their columns but those to ``drop``, and are sent on after
    every slice. Columns of the same names must not be there.
    """
    small_batches(rows.sparkSession)
    stay = [i for i, field in enumerate(rows.schema.fields) if field.name not in drop]
    schema = StructType([*(rows.schema.fields[i] for i in stay), *(StructField(name, kind) for name, kind in fields)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                columns = [*(part.column(i) for i in stay), *function(part)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            del batch
        give_back()

    return rows.mapInArrow(work, schema)
