"""Near-duplicates by bottom-k sketches from one hash function.

A document is the set of its word shingles, hashed once with 64 bits. Its sketch is the
``k`` smallest hash values. Two sets with a Jaccard index J have each value of their
*union's* sketch in common with probability J, which gives both steps:

* candidates: inverted lists over the retained values. A list is keyed by a run of values
  that follow each other in a sketch. If at most the share 1 - J of the union's sketch is
  not common, some run between the gaps has a sure length (``sure_run``): 5 at 0.85, 4 at
  0.8, less for sets of under ``SMALL`` values. So sets that are retained whole never miss
  each other, and sampled ones with a probability below 1e-8 at the threshold; yet a
  passage that many documents share, being a part of each, is seldom a whole run;
* filter: the share of the union's sketch that both have estimates J; six standard errors
  below the threshold a pair is dropped, and at once below it if both sets are whole.

What is left is decided on the full shingle sets, made again from the texts.

No list is expanded into all its pairs. Documents with equal sets are one class first.
Each list gives its smallest class as leader, and members are compared with leaders only.
What is left are members of one leader in different components, such as heavy edits of one
text that are not near each other. They are compared too, so no link between different
texts is lost, but only if they can be linked: the common shingles of two sets are at most
the shingles that each has in common with any other set of the kind. That number, c, is
counted in one aggregate, and two sets of n and m shingles have J >= t only if
min(c) >= t / (1 + t) (n + m). An edit has shingles of its own, and this bound ends most of
them. Those within it are compared as whole sets inside the join.

Components come from alternating stars on the link table, written out each round.

Defined cases: null or empty texts, and those without words, have an empty set and are
linked with nothing; fewer words than a shingle are one shingle; rows without an id are
linked with nothing; equal ids are one node. Columns of ``docs`` other than id and text
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from flowlake.llm import worker
from flowlake.session import scratch_path

#: Unions of so many values and more are sure of the longer run.
SMALL = 20
#: Ids sent to all tasks at most; beyond it the tables are shuffled.
BROADCAST_IDS = 1_000_000
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
SETS = "doc_id bigint, n_shingles bigint, signature binary, sketch array<bigint>"


class WordHashes(worker.Memory):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        self.grow(word, value)
        return value


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted, distinct hash values of a text's word shingles."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    hashes = worker.kept("near duplicates", WordHashes)
    if hashes.full:
        hashes.clear()
    if len(words) < size:
        joined = b"\x00".join([b"short", *words])
        return np.array([xxhash.xxh3_64_intdigest(joined)] if words else [], np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    hashed = np.zeros(n, np.uint64)
    for i in range(size):
        hashed = (hashed + values[i:i + n]) * MULTIPLIERS[i % 3]
        hashed ^= hashed >> np.uint64(32)
    hashed *= MULTIPLIERS[1]
    hashed ^= hashed >> np.uint64(29)
    return np.unique(hashed)


def sketch_sets(docs: DataFrame, doc_id: str, text: str, size: int, k: int) -> DataFrame:
    """Set size, signature of the whole set, and its ``k`` smallest values, per document."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    worker.small_batches(docs.sparkSession)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, signatures, kept = [], [], []
            for value in batch.column(1):
                found = shingle_set(value.as_py(), size)
                sizes.append(len(found))
                signatures.append(xxhash.xxh3_128_digest(found.tobytes()))
                kept.append(found[:k].view(np.int64))
            offsets = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            values = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.ListArray.from_arrays(offsets, values)],
                names=["doc_id", "n_shingles", "signature", "sketch"],
            )
        worker.give_back()

    return rows.mapInArrow(sketch, SETS)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sure_run(percent: int, least: int) -> int:
    """The run that two sketches have in common, if at least ``percent`` of ``least`` or more values are."""
    runs = []
    for union in range(least, 1000):
        gaps = union * (100 - percent) // 100
        if gaps:
            runs.append(-(-(union - gaps) // (gaps + 1)))
    return min(runs)


def inverted_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(leader, class_id) for the classes that share a list with their list's smallest class."""

    def keys(run: int) -> Column:
        last = F.size("sketch") - run
        key = lambda i: F.xxhash64(F.lit(run), *[F.get("sketch", i + step) for step in range(run)])
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), key)).otherwise(F.array().cast("array<bigint>"))

    short, long = sure_run(percent, 2), sure_run(percent, SMALL)
    nothing = F.array().cast("array<bigint>")
    # A small union has two small sets; both kinds are kept where a set may be in either.
    both = F.concat(
        F.when(F.col("n_shingles") * percent <= SMALL * 100, keys(short)).otherwise(nothing),
        F.when(F.col("n_shingles") * 100 >= SMALL * percent, keys(long)).otherwise(nothing),
    )
    entries = classes.select("class_id", F.explode(F.array_distinct(both)).alias("list"))
    leaders = entries.groupBy("list").agg(F.min("class_id").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = entries.join(leaders.drop("n"), "list").filter("class_id <> leader")
    return stored(pairs.select("leader", "class_id").distinct(), "lists")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, k: int) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard index of ``percent`` or more."""
    margin = 6.0 * (percent / 100 * (1 - percent / 100) / k) ** 0.5

    @F.pandas_udf("boolean")
    def plausible(a: pd.Series, a_size: pd.Series, b: pd.Series, b_size: pd.Series) -> pd.Series:
        out = []
        for one, n, other, m in zip(a, a_size, b, b_size):
            one, other = one.view(np.uint64), other.view(np.uint64)
            both = np.intersect1d(one, other, assume_unique=True)
            union = np.union1d(one, other)
            if n <= k and m <= k:
                out.append(100 * len(both) >= percent * len(union))
            else:
                top = union[:k]
                shared = np.searchsorted(both, top[-1], "right")
                out.append(shared / len(top) >= percent / 100 - margin)
        return pd.Series(out)

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for one, other in zip(a, b):
            one, other = shingle_set(one, size), shingle_set(other, size)
            both = len(np.intersect1d(one, other, assume_unique=True))
            out.append(both > 0 and 100 * both >= percent * (len(one) + len(other) - both))
        return pd.Series(out)

    side = lambda name: classes.select(F.col("class_id").alias(name), F.col("sketch").alias(f"{name}_sketch"), F.col("n_shingles").alias(f"{name}_n"))
    with_sketches = pairs.join(side("a"), "a").join(side("b"), "b")
    near = with_sketches.filter(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    near = stored(near.filter(plausible("a_sketch", "a_n", "b_sketch", "b_n")).select("a", "b"), "near")

    ids = near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = stored(texts_of(ids, docs), "texts")
    whole = near.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")
    return stored(whole.filter(linked("a_text", "b_text")).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the links (a, b)."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    state = edges_state(edges)
    while True:
        # Large star: larger neighbours are tied to the smallest node around.
        around = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large, "large")
        # Small star: smaller neighbours and the node itself are tied to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored(tied.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, edges_state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def edges_state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def full_sets(ids: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(class_id, shingles): the whole sets of the given classes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text.as_py(), size).view(np.int64) for text in batch.column(1)]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, values)], names=["class_id", "shingles"])
        worker.give_back()

    return texts_of(ids, docs).select("doc_id", "text").mapInArrow(make, "class_id bigint, shingles array<bigint>")


def own_shingles(sets: DataFrame) -> DataFrame:
    """(class_id, own): shingles that no other of the given classes has."""
    rows = sets.select("class_id", F.explode("shingles").alias("shingle"))
    once = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("class_id").alias("class_id")).filter("n = 1")
    return once.groupBy("class_id").agg(F.count(F.lit(1)).alias("own"))


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])


def crossing(lists: DataFrame, groups: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between members of one leader that lie in different components.

    The join compares the whole sets of those that can be linked, so only links leave it.
    """
    placed = lists.join(groups.withColumnRenamed("node", "class_id"), "class_id", "left")
    placed = placed.select("leader", "class_id", F.coalesce("component", "class_id").alias("component"))
    mixed = placed.groupBy("leader").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    placed = stored(placed.join(mixed.select("leader"), "leader", "left_semi"), "placed")
    ids = stored(placed.select(F.col("class_id").alias("doc_id")).distinct(), "placed-ids")
    sets = stored(full_sets(ids, docs, size), "full-sets")
    counted = classes.select("class_id", "n_shingles").join(own_shingles(sets), "class_id", "left")
    common = counted.select("class_id", F.col("n_shingles").alias("n"), (F.col("n_shingles") - F.coalesce("own", F.lit(0))).alias("c"))
    able = placed.join(common, "class_id").filter(100 * F.col("c") >= percent * F.col("n"))
    # The largest partner that a set's common shingles allow, and the smallest there is.
    able = able.withColumn("most", F.floor(F.col("c") * (100 + percent) / percent) - F.col("n"))
    smallest = able.groupBy("leader").agg(F.min("n").alias("least"))
    able = stored(able.join(smallest, "leader").filter("most >= least").drop("least"), "able")
    able = able.join(sets, "class_id")
    columns = ("class_id", "component", "n", "most", "shingles")
    side = lambda x: able.select("leader", *[F.col(c).alias(f"{x}_{c}" if c != "class_id" else x) for c in columns])
    fit = "a < b and a_component <> b_component and a_n <= b_most and b_n <= a_most"
    fit += f" and 100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)"
    fit += f" and {100 + percent} * size(array_intersect(a_shingles, b_shingles)) >= {percent} * (a_n + b_n)"
    return side("a").join(side("b"), "leader").filter(fit).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, k: int = 96) -> DataFrame:
    """One row per document: set size, class, component and whether it is kept."""
    plain = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    sets = stored(sketch_sets(plain, "doc_id", "text", size, k), "sets")
    full = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("signature").agg(
        F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    classes = stored(classes, "classes")
    members = sets.drop("sketch").join(classes.select("signature", "class_id"), "signature", "left")
    members = members.withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")))
    # Equal ids are one node.
    same = full.groupBy("doc_id").agg(F.min("signature").alias("low"), F.max("signature").alias("high")).filter("low <> high")

    lists = inverted_lists(classes, percent)
    to_leaders = lists.select(F.col("leader").alias("a"), F.col("class_id").alias("b"))
    links = [verified(to_leaders, classes, plain, size, percent, k)]
    repeated = members.join(same.select("doc_id"), "doc_id", "left_semi").filter("class_id is not null")
    links.append(stored(repeated.groupBy("doc_id").agg(F.collect_set("class_id").alias("c")).select(
        F.explode("c").alias("a"), F.array_min("c").alias("b")).filter("a <> b"), "same"))
    groups = components(reduce(DataFrame.unionAll, links))
    rest = stored(crossing(lists, groups, classes, plain, size, percent), "rest")
    if rest.take(1):
        groups = components(reduce(DataFrame.unionAll, [*links, rest]))

    found = members.join(groups.withColumnRenamed("node", "class_id"), "class_id", "left")
    component = F.when(F.col("class_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "class_id"))
    return found.select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
