import pyarrow as pa
from pyspark.sql.types import LongType

from flowlake.llm import worker


def test_one_operator_at_a_time():
    made = []
    one = lambda content: made.append(content) or {"of": content}
    first = worker.kept("a", one, "x" * 3)
    assert worker.kept("a", one, "".join("xxx")) is first and made == ["xxx"]
    assert worker.kept("a", one, "y") is not first and worker.kept("a", dict) == {}
    worker.begin("a")
    assert worker.kept("a", one, "y") == {"of": "y"} and made == ["xxx", "y"]
    worker.begin("b")
    assert worker._Shelf.things == {}
    worker.kept("a", one, "y")
    assert made == ["xxx", "y", "y"]


def test_memory_counts_bytes():
    memory = worker.Memory(1000)
    for i in range(3):
        memory[i] = "x" * 300
        memory.grow(i, memory[i])
    assert memory.full
    memory.clear()
    assert not memory.full and not memory and memory.size == 0


def test_rows_in_slices(spark):
    rows = spark.range(1000).selectExpr("id", "cast(id as string) as text", "struct(id) as s", "id % 2 as extra")

    def make():
        sizes = []

        def function(part):
            sizes.append(part.num_rows)
            assert max(sizes) <= worker.SLICE
            return [pa.array([len(v.as_py()) for v in part.column(1)], pa.int64())]

        return function

    got = worker.with_columns(rows, [("n", LongType())], make, drop=("extra",))
    assert got.columns == ["id", "text", "s", "n"]
    assert all(r["n"] == len(str(r["id"])) and r["s"]["id"] == r["id"] for r in got.collect()) and got.count() == 1000
    assert worker.with_columns(rows.limit(0), [("n", LongType())], make).count() == 0
