"""Joins to small tables, and what to do when they are not small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlake.contract import ATTACK_CATEGORIES

BOUNDED_ROWS = 10_000


def attack_categories(spark: SparkSession) -> DataFrame:
    """The attack type to category lookup: nine constant rows."""
    rows = ", ".join(f"('{kind}', '{category}')" for kind, category in ATTACK_CATEGORIES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS seed(attack_type, attack_category)")


def bounded(df: DataFrame, max_rows: int = BOUNDED_ROWS) -> DataFrame | None:
    """The table as local rows when it has at most ``max_rows`` of them, else None."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def lookup_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "left", max_rows: int = BOUNDED_ROWS
) -> DataFrame:
    """Null-safe join that broadcasts ``small`` only after its rows have been counted.

    A lookup beyond the bound is joined without a hint: the big side is then
    shuffled on the key, and adaptive execution splits partitions that a hot key
    makes too large.
    """
    local = bounded(small, max_rows)
    right = small if local is None else F.broadcast(local)
    names = {name: f"__{name}" for name in on}
    right = right.withColumnsRenamed(names)
    match: Column = F.lit(True)
    for name, other in names.items():
        match = match & F.col(f"`{name}`").eqNullSafe(F.col(f"`{other}`"))
    return big.join(right, match, how).drop(*names.values())


def join_predictions(predictions: DataFrame, flows: DataFrame, now: Column | None = None) -> DataFrame:
    """Put each flow's own time on predictions that were made elsewhere.

    Predictions without a flow, or with a flow that has no time, take the
    scoring time. An id that several flows have takes their latest time, so no
    prediction is multiplied.
    """
    now = F.current_timestamp() if now is None else now
    times = flows.groupBy("event_id").agg(F.max("ingestion_timestamp").alias("flow_timestamp"))
    return predictions.join(times, "event_id", "left").withColumn(
        "flow_timestamp", F.coalesce("flow_timestamp", now)
    )


def without_prediction(flows: DataFrame, predictions: DataFrame) -> DataFrame:
    """Flows that no prediction refers to yet."""
    return flows.join(predictions.select("event_id"), "event_id", "left_anti")
