"""Dataset profiling: counts, nulls, redundancy, order and leakage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowlake.contract import columns_of_kind
from flowlake.functions.scalar import quoted
from flowlake.operators.ordered import exact_quantiles, previous_value, running_totals


def _per_column(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """One aggregate over all columns, turned into one row per column."""
    aggregates = [
        make(quoted(name)).alias(f"m{i}_{key}")
        for i, name in enumerate(columns) for key, make in measures.items()
    ]
    rows = [
        F.struct(F.lit(name).alias("column_name"), *[F.col(f"m{i}_{key}").alias(key) for key in measures])
        for i, name in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    value = quoted(column)
    return (
        df.filter(value.isNotNull()).groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    counted = _per_column(df, columns or df.columns, {"nulls": lambda c: F.count_if(c.isNull())})
    return counted.orderBy(F.desc("nulls"), "column_name")


def null_rates(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Share of nulls per group, one column each."""
    return df.groupBy(group).agg(*[F.avg(quoted(c).isNull().cast("int")).alias(c) for c in columns])


def _as_text(df: DataFrame, name: str) -> Column:
    """A value as text; equal numbers have equal texts, so -0.0 is 0.0."""
    value = quoted(name)
    if df.select(value).schema[0].dataType.typeName() in ("double", "float"):
        value = F.when(value == 0, F.lit(0.0).cast(df.select(value).schema[0].dataType)).otherwise(value)
    return value.cast("string")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct non-null values per column.

    The pairs (column, value) are made distinct where they are read, so a
    frequent value is shuffled once per task and not once per row.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("column_name"), _as_text(df, n).alias("v")) for n in columns])
    )
    distinct = df.select(pairs.alias("p")).select("p.*").distinct()
    return distinct.groupBy("column_name").agg(F.count("v").alias("distinct_values"))


def distinct_per_group(df: DataFrame, group: str, column: str) -> DataFrame:
    pairs = df.select(group, column).distinct()
    return pairs.groupBy(group).agg(F.count(column).alias("distinct_values"))


def equal_share(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Share of rows in which two columns agree; null agrees with nothing."""
    shares = [
        F.avg(F.coalesce(quoted(a) == quoted(b), F.lit(False)).cast("int")).alias(f"s{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    rows = [
        F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"s{i}").alias("share"))
        for i, (a, b) in enumerate(pairs)
    ]
    return df.agg(*shares).select(F.inline(F.array(*rows)))


def numeric_ranges(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Smallest and largest value per numeric column; hidden sentinels show up here."""
    measures = {
        "min_value": lambda c: F.min(c).cast("double"), "max_value": lambda c: F.max(c).cast("double")
    }
    return _per_column(df, columns or columns_of_kind(df, "number"), measures)


def group_means(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(quoted(c)).alias(c) for c in columns])


def class_audit(df: DataFrame, group: str, column: str) -> DataFrame:
    """Spread of one feature per class: a fingerprint has almost none."""
    value = quoted(column)
    return df.groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, as name and value rows."""
    value = quoted(column)
    basics = {
        "count": F.count(value).cast("double"), "mean": F.avg(value), "std": F.stddev_samp(value),
        "min": F.min(value).cast("double"), "max": F.max(value).cast("double"),
    }
    first = df.agg(*[c.alias(n) for n, c in basics.items()])
    quartiles = exact_quantiles(df.select(value.cast("double").alias("v")), "v", [0.25, 0.5, 0.75])
    names = {"25%": 0, "50%": 1, "75%": 2}
    return _rows(first, {n: F.col(n) for n in basics}).unionByName(
        _rows(quartiles, {n: F.get("quantiles", F.lit(i)) for n, i in names.items()})
    )


def _rows(one_row: DataFrame, values: dict[str, Column]) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("statistic"), c.alias("value")) for n, c in values.items()]
    return one_row.select(F.inline(F.array(*pairs)))


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier one in every column."""
    groups = df.groupBy(*[quoted(c) for c in columns or df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


# ---- order of the rows -------------------------------------------------------


def with_resets(df: DataFrame, row_id: str, counter: str) -> DataFrame:
    """Flag rows whose counter is below that of the row before."""
    before = previous_value(df, row_id, counter, "__prev")
    reset = F.coalesce((quoted(counter) < F.col("__prev.value")), F.lit(False))
    return before.withColumn("is_reset", reset.cast("int")).drop("__prev")


def reset_segments(df: DataFrame, row_id: str, counter: str) -> DataFrame:
    """Number the stretches between counter resets, from 0."""
    flagged = with_resets(df, row_id, counter)
    return running_totals(flagged, row_id, {"segment_id": "is_reset"}).drop("segment_id_total")


def label_blocks(df: DataFrame, row_id: str, label: str) -> DataFrame:
    """Number the contiguous blocks of equal labels, from 1; a null label never continues a block."""
    before = previous_value(df, row_id, label, "__prev")
    starts = F.coalesce(quoted(label) != F.col("__prev.value"), F.lit(True)).cast("int")
    flagged = before.withColumn("is_start", starts).drop("__prev")
    return running_totals(flagged, row_id, {"block_id": "is_start"}).drop("block_id_total")


def run_lengths(df: DataFrame, run: str) -> DataFrame:
    return df.groupBy(run).agg(F.count(F.lit(1)).alias("length"))


def blocks_per_label(blocks: DataFrame, label: str) -> DataFrame:
    """How many blocks each label has: its block starts."""
    return (
        blocks.filter("is_start = 1").groupBy(label)
        .agg(F.count(F.lit(1)).alias("blocks")).orderBy(F.desc("blocks"), label)
    )


def mixed_segments(segments: DataFrame, label: str) -> DataFrame:
    """Segments, and how many of them hold more than one label."""
    per_segment = distinct_per_group(segments, "segment_id", label)
    return per_segment.agg(
        F.count(F.lit(1)).alias("segments"),
        F.count_if(F.col("distinct_values") > 1).alias("mixed_segments"),
    )




def histogram(df: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """Rows per bin of given edges, numbered from 1; values outside the edges are dropped.

    A bin holds its lower edge, the last one also its upper edge.
    """
    value = quoted(column)
    reached = F.size(F.filter(F.lit(edges), lambda e: e <= value))
    inside = df.filter((value >= edges[0]) & (value <= edges[-1]))
    return inside.groupBy(F.least(reached, F.lit(len(edges) - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
