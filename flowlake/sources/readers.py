"""Batch and stream sources. The table format is a parameter everywhere."""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from flowlake import contract
from flowlake.functions.scalar import quoted, typed
from flowlake.operators.sampling import sample_rows
from flowlake.sources.batches import Store

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def read_capture(spark: SparkSession, path: str) -> DataFrame:
    """A raw capture CSV with contract types, whatever the order of its columns.

    Files are grouped by their header line, each group is read by its own header, and the
    groups are joined by name; a column that a group lacks is null there. There is no pass
    to infer types. Text that does not parse becomes null, integers may be written with a
    decimal point.
    """
    groups = capture_groups(spark, path)
    if len(groups) > 1:
        parts = [_typed_capture(spark.read.option("header", True).csv(files)) for files in groups]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _typed_capture(spark.read.option("header", True).csv(path))


def capture_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The capture's files by header line; empty files are in none.

    Only the first line of each file is read, while the files are listed, so the capture itself is scanned once.
    """
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    given = jvm.org.apache.hadoop.fs.Path(path)
    files = given.getFileSystem(settings)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings)
    groups: dict[str, list[str]] = {}
    for root in files.globStatus(given) or []:
        listing = files.listFiles(root.getPath(), True)
        while listing.hasNext():
            file = listing.next().getPath()
            if file.getName().startswith(("_", ".")):
                continue
            stream = files.open(file)
            codec = codecs.getCodec(file)
            text = codec.createInputStream(stream) if codec is not None else stream
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8"))
            line = reader.readLine()
            reader.close()
            if line is not None:
                groups.setdefault(line, []).append(file.toString())
    return [sorted(files) for _, files in sorted(groups.items())]


def _typed_capture(text: DataFrame) -> DataFrame:
    kinds = {f.name: f.kind for f in contract.FEATURES}
    kinds |= {name: "category" for name in contract.LABELS}
    # The leftover index of an export has an empty header.
    names = {name: "Unnamed: 0" if name in ("_c0", "") else name for name in text.columns}
    return text.select(
        [typed(quoted(name), kinds.get(shown, "float")).alias(shown) for name, shown in names.items()]
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None when nothing has been written there yet."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"):
            return None
        raise


def read_sample(df: DataFrame, n: int = 50_000, id_column: str = "event_id", seed: int = 42) -> DataFrame:
    """The whole table when it has at most ``n`` rows, else exactly ``n`` seeded rows."""
    return sample_rows(df, n, id_column, seed)


def event_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    servers: str | None = None,
    topic: str = "flows-raw",
    max_offsets: int | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Keyed events as a stream, with the columns of a message log; no rate limit unless one is given.

    Kafka needs its connector on the cluster. ``json`` and ``parquet`` follow a
    folder of files with the same columns.
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
        )
        return (reader if max_offsets is None else reader.option("maxOffsetsPerTrigger", max_offsets)).load()
    return table_stream(spark, path, fmt, RECORD_SCHEMA, max_files)


def table_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """Follow a table as a stream, with a number of files per micro-batch if one is given."""
    reader = spark.readStream.format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def cache_key(engineer: bool, *parts: str) -> str:
    text = "|".join([repr(contract.FEATURES), contract.SCHEMA_VERSION, str(engineer), *parts])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A digest of the names, sizes and times of the files in the given folders (or of the given files)."""
    hadoop, found = spark._jvm.org.apache.hadoop.fs.Path, []
    for path in paths:
        root = hadoop(path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        listing = files.listFiles(root, True)
        while listing.hasNext():
            status = listing.next()
            if not status.getPath().getName().startswith(("_", ".")):
                found.append(f"{status.getPath()}|{status.getLen()}|{status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def load_or_build(
    spark: SparkSession, root: str, build: Callable[[], DataFrame], engineer: bool = True, source: str = "", inputs: tuple[str, ...] = ()
) -> DataFrame:
    """A prepared table from its cache folder, built on first use.

    The folder is named after the contract, the options and the files of ``inputs`` (names,
    sizes, times), so a changed contract or a changed capture builds a new table. It counts as built
    once the writer's mark of success is there; a folder that was left unfinished is written again.
    """
    parts = [source, fingerprint(spark, *inputs)] if inputs else [source]
    path = f"{root.rstrip('/')}/{'engineered' if engineer else 'plain'}-{cache_key(engineer, *parts)}"
    if not Store(spark, path).exists(f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
