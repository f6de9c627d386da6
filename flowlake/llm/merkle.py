"""Merkle manifest of a table: a digest per row, per group and for the whole, with proofs.

Each row has a leaf digest. Within a group the leaves are ordered and numbered; every
``FANOUT`` consecutive nodes become one node, level by level, until one is left: the
group's root. The roots of the groups, in the order of the groups, become one root alike.

A level is a slot pivot: nodes are grouped by their number divided by the fanout, and
conditional aggregates spread the children of a parent into ``FANOUT`` columns. The digest of
these columns put together is the parent; the columns without a node's own slot are its
siblings. On the way down the pivoted rows meet their parents' proofs, and each row gives one
proof per slot. The documents' ids travel in the pivot of the leaves, so proofs never meet the
table itself again.

At scale: the rows are numbered by ranges of (group, order), so that no group is sorted in one
task; a pivot has at most ``FANOUT`` rows per key; levels shrink by the fanout and are stored,
so all levels together are half as many rows as the leaves. The only number that comes to the
driver is the size of the largest group, for the number of levels.

Defined cases: a null group comes first and is a group of its own, apart from the empty
string; null order values come first; rows of the same place and digest are interchangeable; a lone
leaf is its group's root without another digest; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.session import materialize

FANOUT = 3
#: Rows of the table of range starts up to which it is sent to all tasks.
SMALL = 100_000
PROOF = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """Byte count, colon and value; a dash for null. No two lists of values give the same text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def sized(frame: DataFrame, rows: int = SMALL) -> DataFrame:
    """The stored frame, marked for broadcast if it has few rows."""
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """The nodes with ``pos``, their number from 0 within ``tree`` in the given order, and ``n``, the tree's size.

    The frame is cut into ranges of (tree, order); within a range rows are numbered as they
    stand. A table with a row per range and tree says where each begins.
    """
    by = [F.col("tree").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    ranged = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), "merkle-order")
    ranged = ranged.withColumn("__range", F.shiftright("__at", 33))
    starts = ranged.groupBy("tree", "__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    tree = Window.partitionBy("tree")
    earlier = F.sum("__rows").over(tree.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.withColumns({"__before": F.coalesce(earlier, F.lit(0)), "n": F.sum("__rows").over(tree)})
    starts = sized(materialize(starts.drop("__rows"), "merkle-starts"))
    placed = ranged.join(starts, ["tree", "__range"])
    return placed.withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__range", "__first", "__before")


def pivot(nodes: DataFrame, payload: list[str], fanout: int) -> DataFrame:
    """One row per parent: its children in columns ``c0``, ``c1``, ..., and its digest. A lone node passes through."""
    slot = F.col("pos") % fanout
    child = F.struct("hash", *payload)
    spread = [F.max(F.when(slot == k, child)).alias(f"c{k}") for k in range(fanout)]
    runs = nodes.groupBy("tree", "n", F.floor(F.col("pos") / F.lit(fanout)).cast("bigint").alias("parent")).agg(*spread)
    together = digest(*[F.coalesce(F.col(f"c{k}.hash"), F.lit("")) for k in range(fanout)])
    return runs.withColumn("hash", F.when(F.col("n") > 1, together).otherwise(F.col("c0.hash")))


def levels(nodes: DataFrame, payload: list[str], fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored pivots from the leaves up, and the root of each tree (tree, hash)."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    found: list[DataFrame] = []
    while True:
        runs = materialize(pivot(nodes, payload if not found else [], fanout), f"merkle-level-{len(found)}")
        found.append(runs)
        largest = -(-largest // fanout)
        if largest <= 1:
            return found, runs.select("tree", "hash")
        fewer = F.ceil(F.col("n") / F.lit(fanout)).cast("bigint")
        nodes = runs.select("tree", F.col("parent").alias("pos"), fewer.alias("n"), "hash")


def proofs(found: list[DataFrame], top: DataFrame, payload: list[str], fanout: int) -> DataFrame:
    """From the roots down: each leaf with its payload, what ``top`` says of its tree, and its proof.

    ``top`` has a row per tree with the proof from there on; a step of a proof is the text
    of the siblings before the own slot and of those behind it.
    """
    carried = [c for c in top.columns if c not in ("tree", "proof")]
    above = top.withColumn("pos", F.lit(0).cast("bigint"))
    for depth in reversed(range(len(found))):
        runs = found[depth].withColumnRenamed("parent", "pos").drop("hash")
        met = runs.join(above, ["tree", "pos"])
        text = lambda ks: F.concat(F.lit(""), *[F.coalesce(F.col(f"c{k}.hash"), F.lit("")) for k in ks])
        slots = []
        for k in range(fanout):
            step = F.struct(text(range(k)).alias("before"), text(range(k + 1, fanout)).alias("after"))
            proof = F.when(F.col("n") > 1, F.concat(F.array(step), "proof")).otherwise(F.col("proof"))
            place = F.when(F.col("n") > 1, F.col("pos") * fanout + k).otherwise(F.col("pos"))
            slots.append(F.when(F.col(f"c{k}").isNotNull(), F.struct(place.alias("pos"), proof.cast(PROOF).alias("proof"), F.col(f"c{k}").alias("child"))))
        one = met.select("tree", *carried, F.explode(F.filter(F.array(*slots), lambda s: s.isNotNull())).alias("__one"))
        kept = [F.col("__one.child.hash").alias("hash"), *[F.col(f"__one.child.{p}").alias(p) for p in payload]] if depth == 0 else []
        above = one.select("tree", *carried, "__one.pos", "__one.proof", *kept)
    return above


def manifest(rows: DataFrame, group: str, order: str, leaf: Column, presented: Column, fanout: int = FANOUT) -> DataFrame:
    """Each row's order value, leaf, roots, proof digest, and whether the leaf that is ``presented`` leads to the root."""
    tree = F.when(F.col(f"`{group}`").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")))
    leaves = rows.select(tree.alias("tree"), F.col(f"`{order}`").alias("place"), leaf.alias("hash"), presented.alias("shown"))
    leaves = leaves.withColumn("shown", F.when(F.col("shown") != F.col("hash"), F.col("shown")))
    payload = ["place", "shown"]
    runs, subroots = levels(numbered(materialize(leaves, "merkle-leaves"), ["place", "hash"]), payload, fanout)
    groups = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    upper, root = levels(numbered(groups, ["name"]), ["name"], fanout)
    start = root.select("tree", F.col("hash").alias("root"), F.array().cast(PROOF).alias("proof"))
    top = proofs(upper, start, ["name"], fanout)
    top = materialize(top.select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), "root", "proof"), "merkle-top")
    found = proofs(runs, top, payload, fanout)
    fold = lambda at, step: digest(step["before"], at, step["after"])
    steps = F.transform("proof", lambda step: F.concat(step["before"], step["after"]))
    folded = F.aggregate("proof", F.coalesce("shown", "hash"), fold)
    return found.select(
        F.col("place").alias(order), F.col("hash").alias("leaf"), "subroot", "root",
        F.sha2(F.array_join(steps, "").cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
