"""A cleaning pipeline over the documents table, stage by stage.

Each stage reads all documents that its predecessor kept. All but the last return the
columns of documents; the last returns the token ids' and texts' digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.llm import bpe, decontamination, language, near_dups, outliers
from flowlake.llm.queries import BYTE_BPE, PIECES
from flowlake.session import scratch_path

#: Ids sent to all tasks at most; beyond it documents and ids are shuffled.
BROADCAST_IDS = 1_000_000

#: The stages take texts and statistics of all rows, models and components; no SQL says that.
ORACLE_SQL = None


def without(docs: DataFrame, rejected: DataFrame, purpose: str) -> DataFrame:
    """The rows whose id is not among the rejected ones. Rows without an id stay."""
    spark = docs.sparkSession
    path = scratch_path(spark, purpose)
    rejected.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id is not null").distinct().write.parquet(path)
    ids = spark.read.schema("doc_id bigint").parquet(path)
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti").select(docs.columns)


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def numbered(docs: DataFrame, purpose: str) -> DataFrame:
    """The documents with ``__row``, a number of their own that every scan gives alike.

    It is the number of the file and the place in it, so nothing is stored; documents that do not come
    straight from files are stored first. The table of files goes to all tasks: it is the list
    that the driver has read them by."""
    try:
        place = docs.select(*docs.columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    except AnalysisException:
        return numbered(stored(docs, f"{purpose}-rows"), purpose)
    names = sorted(r[0] for r in place.select("__file").distinct().collect())
    files = docs.sparkSession.createDataFrame(list(enumerate(names)), "__number bigint, __name string")
    found = place.join(F.broadcast(files), F.col("__file") == F.col("__name"))
    return found.select(*docs.columns, F.shiftleft("__number", 40).bitwiseOR(F.col("__index")).alias("__row"))


def judged_by_row(docs: DataFrame, rejected: Callable[[DataFrame, DataFrame], DataFrame], purpose: str) -> DataFrame:
    """The documents without the rows that are rejected.

    A number per row takes the place of ``doc_id`` while a stage judges, so rows without an id
    and rows that share one are told apart. ``rejected`` gets these rows and, per number, the
    id of the document (``own_id``) and a digest of id and text."""
    rows = numbered(docs, purpose)
    digest = F.sha2(F.to_json(F.struct("doc_id", "text"), {"ignoreNullFields": "false"}).cast("binary"), 256)
    owners = rows.select(F.col("__row").alias("doc_id"), F.col("doc_id").alias("own_id"), digest.alias("digest"))
    left = without(rows.withColumnRenamed("doc_id", "__id").withColumnRenamed("__row", "doc_id"), rejected(rows.drop("doc_id").withColumnRenamed("__row", "doc_id"), owners), purpose)
    return left.select(*[F.col("__id").alias(c) if c == "doc_id" else c for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters go, and those that no language explains better than the others."""
    found = language.identify(docs, language.fit(docs, "text", "lang", PIECES), names=("__lang", "__score"))
    return found.filter((F.col("__lang") != language.UNKNOWN) & (F.col("__score") >= 0.5)).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the base rules or are outliers for their language and source go."""
    return judged_by_row(docs, lambda rows, _: outliers.judge(rows).filter("not kept"), "outliers")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies, and of rows of the same id and text, stays: that of the lowest id."""

    def copies(rows: DataFrame, owners: DataFrame) -> DataFrame:
        found = near_dups.near_duplicates(rows, size=3, percent=85).select("doc_id", "n_shingles", "component_id")
        found = found.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")))
        found = stored(found.join(owners, "doc_id"), "copies-found")
        group = ("component_id", F.when(F.col("component_id").isNull(), F.col("digest")))
        first = F.min(F.struct(F.col("own_id").isNull().alias("none"), "own_id", "doc_id"))
        kept = found.groupBy(*group).agg(first.alias("first")).select("first.doc_id")
        return found.join(kept, "doc_id", "left_anti")

    return judged_by_row(docs, copies, "copies")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go, whether its item has an id or not."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = stored(items.select(F.monotonically_increasing_id().alias("item_id"), "text"), "items")
    return judged_by_row(docs, lambda rows, _: decontamination.contamination(rows, items).filter("n_hit > 0"), "contaminated")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token ids, with the digest of the text that they give back."""
    both = bpe.round_trip(docs, BYTE_BPE)
    return both.select(
        "doc_id", "lang", "source", "n_tokens", "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        found = stage(spark, docs, sf_dir)
        path = scratch_path(spark, name.lower().replace(" ", "-"))
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
