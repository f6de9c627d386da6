"""Ordered work (running totals, previous row, exact quantiles) without one big sort task.

A window over a whole table, or over one feature of it, would put everything in
one task. Here the order key is cut into ranges that hold about equally many
rows, each range is scanned on its own, and the state at the end of a range is
carried over through a table with one row per range.

The key must be distinct within its group: callers either have a unique row
number or aggregate equal values first, which is also what removes hot values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.functions.scalar import quoted
from flowlake.operators.lookup import bounded
from flowlake.session import materialize

BUCKET = "__range"
MAX_GROUPS = 5_000


#: Rows of a range beyond which a table without groups gets more ranges, and sampled keys per range.
ROWS_PER_RANGE = 4_000_000
SAMPLED_KEYS = 100
#: Ranges with a wanted rank that are sent to all tasks at most.
WANTED = 100_000


def _bucket_root(df: DataFrame, rows: int | None = None) -> int:
    """Square root of the number of ranges; it follows the session's shuffle width.

    Without groups it follows the rows as well. With groups there are boundaries for each
    group, so their number is bounded.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows is None:
        return min(64, max(4, math.ceil(math.sqrt(width))))
    return max(4, math.ceil(math.sqrt(max(width, rows / ROWS_PER_RANGE))))


def _sampled(df: DataFrame, key: str, rows: int, count: int) -> DataFrame:
    """Enough keys to place the boundaries, so that their sketch is small whatever the table's size."""
    enough = SAMPLED_KEYS * count
    return df.select(key) if rows <= enough else df.select(key).sample(enough / rows, seed=7)


def _same(groups: list[str], group_bound: int | None) -> Column:
    """Equal groups. Without nulls a plain equality keeps the partitioning of the ordered scan."""
    match = F.lit(True)
    for g in groups:
        left, right = F.col(f"`{g}`"), F.col(f"`__{g}`")
        match = match & (left.eqNullSafe(right) if group_bound is None else left == right)
    return match


def with_ranges(
    df: DataFrame, key: str, groups: list[str] | None = None, group_bound: int | None = None
) -> DataFrame:
    """Add a range number that grows with ``key`` within each group.

    ``group_bound`` is for callers that know how many groups there can be and
    that none is null, such as one per column of a table; otherwise the groups
    are counted before their boundaries are broadcast.

    Boundaries come from an approximate-quantile sketch, without groups on a sample
    of keys with a bounded size, so they only decide
    how even the ranges are and never what the result is. They are computed once
    and fixed before they are used: a sketch that is computed again may differ a
    little, and all branches of a plan must agree on the ranges. A row finds its
    range in two short steps over the boundaries.
    """
    groups = list(groups or [])
    rows = None if groups else df.count()
    root = _bucket_root(df, rows)
    count = root * root
    sketch = F.percentile_approx(
        key, [i / count for i in range(1, count)], F.lit(max(1000, 20 * count))
    )
    if groups:
        every = F.transform(
            F.sequence(F.lit(root - 1), F.lit(count - 2), F.lit(root)), lambda i: F.get("__bounds", i)
        )
        bounds = df.groupBy(*groups).agg(sketch.alias("__bounds")).withColumn("__steps", every)
        limit = MAX_GROUPS if group_bound is None else group_bound
        fixed = bounded(bounds, min(limit, MAX_GROUPS))
        named = materialize(bounds, "ranges") if fixed is None else F.broadcast(fixed)
        named = named.withColumnsRenamed({g: f"__{g}" for g in groups})
        joined = df.join(named, _same(groups, group_bound), "left").drop(*[f"__{g}" for g in groups])
    else:
        found = _sampled(df, key, rows, count).agg(sketch.alias("b")).first()["b"]
        kind = f"array<{df.schema[key].dataType.simpleString()}>"
        joined = df.withColumns(
            {
                "__bounds": F.lit(found).cast(kind),
                "__steps": F.lit(found[root - 1 :: root] if found else None).cast(kind),
            }
        )
    reached = lambda bounds: F.coalesce(F.size(F.filter(bounds, lambda b: b <= F.col(key))), F.lit(0))
    return (
        joined.withColumn("__coarse", reached(F.col("__steps")))
        .withColumn("__fine", F.slice("__bounds", F.col("__coarse") * root + 1, root - 1))
        .withColumn(BUCKET, F.col("__coarse") * root + reached(F.col("__fine")))
        .drop("__bounds", "__steps", "__coarse", "__fine")
    )


def running_totals(
    df: DataFrame,
    key: str,
    totals: dict[str, str | Column],
    groups: list[str] | None = None,
    group_bound: int | None = None,
) -> DataFrame:
    """Add running sums ``{output: input}`` in key order, per group, current row included.

    The sum over the whole group comes along as ``<output>_total``.
    """
    groups = list(groups or [])
    ranged = df if BUCKET in df.columns else with_ranges(df, key, groups, group_bound)
    inputs = {out: F.col(c) if isinstance(c, str) else c for out, c in totals.items()}
    scan = (
        Window.partitionBy(*groups, BUCKET).orderBy(key)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.withColumns({f"__l_{out}": F.sum(c).over(scan) for out, c in inputs.items()})
    ends = ranged.groupBy(*groups, BUCKET).agg(*[F.sum(c).alias(f"__t_{out}") for out, c in inputs.items()])
    group = Window.partitionBy(*groups)
    earlier = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(f"`{g}`").alias(f"__{g}") for g in groups],
        F.col(BUCKET).alias("__carry_range"),
        *[F.coalesce(F.sum(f"__t_{out}").over(earlier), F.lit(0)).alias(f"__c_{out}") for out in inputs],
        *[F.sum(f"__t_{out}").over(group).alias(f"{out}_total") for out in inputs],
    )
    joined = local.join(carried, _same(groups, group_bound) & (F.col(BUCKET) == F.col("__carry_range")))
    return joined.select(
        *ranged.columns,
        *[(F.col(f"__l_{out}") + F.col(f"__c_{out}")).alias(out) for out in inputs],
        *[f"{out}_total" for out in inputs],
    )


def previous_value(
    df: DataFrame,
    key: str,
    column: str,
    out: str,
    groups: list[str] | None = None,
    group_bound: int | None = None,
) -> DataFrame:
    """Add ``out``: a struct with the value in the row before, null in the first row."""
    groups = list(groups or [])
    ranged = df if BUCKET in df.columns else with_ranges(df, key, groups, group_bound)
    value = F.struct(F.col(column).alias("value"))
    local = ranged.withColumn(
        "__lag", F.lag(value).over(Window.partitionBy(*groups, BUCKET).orderBy(key))
    )
    ends = ranged.groupBy(*groups, BUCKET).agg(F.max_by(value, F.col(key)).alias("__end"))
    carried = ends.select(
        *[F.col(f"`{g}`").alias(f"__{g}") for g in groups],
        F.col(BUCKET).alias("__carry_range"),
        F.lag("__end").over(Window.partitionBy(*groups).orderBy(BUCKET)).alias("__before"),
    )
    joined = local.join(carried, _same(groups, group_bound) & (F.col(BUCKET) == F.col("__carry_range")))
    return joined.select(*ranged.columns, F.coalesce("__lag", "__before").alias(out))


def value_table(
    df: DataFrame, value: str, counts: dict[str, Column], groups: list[str] | None = None
) -> DataFrame:
    """Distinct values with counts, as a stored table; NaN and null values are left out.

    Boundaries, range ends and the ordered scan all read it.
    """
    kept = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = kept.groupBy(*(groups or []), value).agg(*[c.alias(name) for name, c in counts.items()])
    return materialize(counted, "values")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    groups: list[str] | None = None,
    group_bound: int | None = None,
) -> DataFrame:
    """Exact quantiles per group as an array; equal to linear interpolation on sorted data.

    Rows are counted per range where they are read. The counts say which ranges hold a
    wanted rank; only the values of these are counted one by one and put in order.
    """
    groups = list(groups or [])
    kept = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*[quoted(g) for g in groups], value)
    ranged = with_ranges(kept, value, groups, group_bound)
    group = Window.partitionBy(*groups)
    counts = ranged.groupBy(*groups, BUCKET).agg(F.count(F.lit(1)).alias("__cnt"))
    upto = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumns({"__upto": F.sum("__cnt").over(upto), "__n": F.sum("__cnt").over(group)})
    place = lambda p: F.lit(p) * (F.col("__n") - 1)
    ranks = F.array_distinct(F.array(*[side(place(p)).cast("bigint") for p in probs for side in (F.floor, F.ceil)]))
    first = F.col("__upto") - F.col("__cnt")
    wanted = counts.withColumns({"__first": first, "__ranks": F.filter(ranks, lambda r: (r >= first) & (r < F.col("__upto")))}).filter(F.size("__ranks") > 0)
    # At most two rows per group and probability.
    wanted = materialize(wanted.select(*[quoted(g) for g in groups], BUCKET, "__first", "__n", "__ranks"), "wanted-ranges")
    few = wanted.limit(WANTED + 1).count() <= WANTED
    named = wanted.withColumnsRenamed({g: f"__{g}" for g in groups} | {BUCKET: "__of"})
    near = ranged.join(F.broadcast(named) if few else named, _same(groups, None) & (F.col(BUCKET) == F.col("__of")))
    values = near.groupBy(*groups, BUCKET, value).agg(F.count(F.lit(1)).alias("__cnt"), F.first("__first").alias("__first"), F.first("__n").alias("__n"), F.first("__ranks").alias("__ranks"))
    run = Window.partitionBy(*groups, BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("__upto", F.col("__first") + F.sum("__cnt").over(run))
    here = F.filter("__ranks", lambda r: (r < F.col("__upto")) & (r >= F.col("__upto") - F.col("__cnt")))
    picks = values.select(*[quoted(g) for g in groups], F.col(value).alias("__value"), "__n", F.explode(here).alias("__rank"))
    found = picks.groupBy(*groups).agg(F.max("__n").alias("__n"), F.map_from_entries(F.collect_list(F.struct("__rank", "__value"))).alias("__at"))
    results = []
    for p in probs:
        low, high = (F.element_at("__at", side(place(p)).cast("bigint")) for side in (F.floor, F.ceil))
        results.append(low + (high - low) * (place(p) - F.floor(place(p))))
    found = found.select(*[quoted(g) for g in groups], F.array(*results).alias("quantiles"))
    if groups:
        return found
    # Without any value there is still one row.
    return df.sparkSession.range(1).select().join(found, how="left")
