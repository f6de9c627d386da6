"""Seeded order, exact samples and exact stratified splits.

Picking the first n rows of every class by a pseudo-random order would put a
whole class in one task. Instead the order key is counted per class and prefix
bucket, the counts tell in which bucket a cut falls, and only the rows of that
bucket are ranked. All other rows are decided where they are read.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.functions.scalar import order_key
from flowlake.operators.lookup import lookup_join

PREFIX_DIGITS = 4  # 65,536 buckets per class


def shuffled(df: DataFrame, id_column: str, seed: int = 42) -> DataFrame:
    """All rows in a reproducible pseudo-random order."""
    return df.orderBy(order_key(id_column, seed), id_column)


def cut_by_rank(
    df: DataFrame,
    id_column: str,
    class_columns: list[str],
    cuts: Callable[[Column], list[Column]],
    out: str = "segment",
    seed: int = 42,
) -> DataFrame:
    """Number each row with how many cut ranks lie before its rank in its class.

    ``cuts`` maps the class size to increasing ranks. ``id_column`` must be
    unique, otherwise rows with the same id may swap places.
    """
    columns = df.columns
    keyed = df.withColumn("__h", order_key(id_column, seed)).withColumn(
        "__b", F.conv(F.substring("__h", 1, PREFIX_DIGITS), 16, 10).cast("int")
    )
    counts = keyed.groupBy(*class_columns, "__b").agg(F.count(F.lit(1)).alias("__c"))
    whole = Window.partitionBy(*class_columns)
    ordered = whole.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulative = counts.withColumns(
        {"__hi": F.sum("__c").over(ordered), "__n": F.sum("__c").over(whole)}
    )
    ranks = cuts(F.col("__n"))
    places = [
        F.min(
            F.when(
                F.col("__hi") >= rank,
                F.struct(
                    F.col("__b").alias("b"),
                    (rank - (F.col("__hi") - F.col("__c"))).alias("take"),
                    (F.col("__hi") == rank).alias("whole"),
                ),
            )
        ).alias(f"__cut{i}")
        for i, rank in enumerate(ranks)
    ]
    if class_columns:
        # One row per class, bounded before it is broadcast.
        plan = cumulative.groupBy(*class_columns).agg(*places)
        marked = lookup_join(keyed, plan, class_columns)
    else:
        row = cumulative.agg(*places).first()
        kind = "struct<b:int,take:bigint,whole:boolean>"
        marked = keyed.withColumns(
            {
                f"__cut{i}": F.lit(None).cast(kind)
                if row[i] is None
                else F.struct(
                    F.lit(row[i]["b"]).alias("b"),
                    F.lit(row[i]["take"]).cast("bigint").alias("take"),
                    F.lit(row[i]["whole"]).alias("whole"),
                )
                for i in range(len(ranks))
            }
        )

    # A cut beyond the class size has no place: every row is before it.
    undecided, settled = F.lit(False), F.lit(0)
    for i in range(len(ranks)):
        cut = F.col(f"__cut{i}")
        inside = cut.isNotNull() & (F.col("__b") == cut["b"])
        undecided = undecided | (inside & ~cut["whole"])
        settled = settled + F.when(cut.isNotNull() & (F.col("__b") > cut["b"]), 1).otherwise(0)
    decided_rows = marked.filter(~F.coalesce(undecided, F.lit(False))).withColumn(out, settled)

    in_bucket = Window.partitionBy(*class_columns, "__b").orderBy("__h", id_column)
    ranked = marked.filter(undecided).withColumn("__r", F.row_number().over(in_bucket))
    ranked_segment = F.lit(0)
    for i in range(len(ranks)):
        cut = F.col(f"__cut{i}")
        after = (F.col("__b") > cut["b"]) | ((F.col("__b") == cut["b"]) & (F.col("__r") > cut["take"]))
        ranked_segment = ranked_segment + F.when(cut.isNotNull() & after, 1).otherwise(0)
    ranked_rows = ranked.withColumn(out, ranked_segment)
    return decided_rows.select(*columns, out).unionByName(ranked_rows.select(*columns, out))


def seeded_places(df: DataFrame, id_column: str, seed: int = 42) -> DataFrame:
    """Add ``place``, the row's position in the seeded order, from 1.

    Rows are ranked inside key prefixes and the counts of the prefixes before
    are added, so no task sees all rows.
    """
    columns = df.columns
    keyed = df.withColumn("__h", order_key(id_column, seed)).withColumn(
        "__b", F.conv(F.substring("__h", 1, PREFIX_DIGITS), 16, 10).cast("int")
    )
    earlier = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = keyed.groupBy("__b").agg(F.count(F.lit(1)).alias("__c")).select(
        F.col("__b").alias("__p"), F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__before")
    )
    ranked = keyed.withColumn(
        "__r", F.row_number().over(Window.partitionBy("__b").orderBy("__h", id_column))
    )
    joined = ranked.join(before, F.col("__b") == F.col("__p"))
    return joined.select(*columns, (F.col("__before") + F.col("__r")).alias("place"))


def sample_rows(df: DataFrame, n: int, id_column: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all, if there are fewer): the first n in seeded order."""
    marked = cut_by_rank(df, id_column, [], lambda size: [F.lit(n).cast("bigint")], "__s", seed)
    return marked.filter("__s = 0").drop("__s")


def shuffled_head(df: DataFrame, n: int, id_column: str, seed: int = 42) -> DataFrame:
    """The first ``n`` rows of the seeded order, in that order."""
    return shuffled(sample_rows(df, n, id_column, seed), id_column, seed)


def sample_per_class(
    df: DataFrame, class_column: str, n: int, id_column: str, seed: int = 42
) -> DataFrame:
    """At most ``n`` rows of every class."""
    marked = cut_by_rank(
        df, id_column, [class_column], lambda size: [F.lit(n).cast("bigint")], "__s", seed
    )
    return marked.filter("__s = 0").drop("__s")


def stratified_split(
    df: DataFrame, class_column: str, id_column: str, seed: int = 42
) -> DataFrame:
    """Add ``split``: 70 % train, 15 % val, 15 % test of every class, exact to one row."""
    percent = lambda size, p: F.floor((size * p + 50) / F.lit(100)).cast("bigint")
    marked = cut_by_rank(
        df, id_column, [class_column], lambda size: [percent(size, 70), percent(size, 85)], "__s", seed
    )
    return marked.withColumn(
        "split", F.when(F.col("__s") == 0, "train").when(F.col("__s") == 1, "val").otherwise("test")
    ).drop("__s")


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight n / (k * n_c) of every class, one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_count"))
    from_all = Window.partitionBy()
    return counts.withColumn(
        "weight",
        F.sum("class_count").over(from_all) / (F.count(F.lit(1)).over(from_all) * F.col("class_count")),
    )
