"""Raw events to the raw and the parsed table, with checks on every micro-batch."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowlake import contract
from flowlake.operators.quality import LOG_SCHEMA, Expectation, Suite, batch_record, broken_rules, silver_suite
from flowlake.sources.batches import read_batches, stream_id, write_batch


#: Columns of the raw table, the log's column of each, and its type if it changes.
RAW_COLUMNS = {
    "kafka_key": ("key", "string"),
    "raw_json": ("value", "string"),
    "topic": ("topic", None),
    "partition": ("partition", None),
    "offset": ("offset", None),
    "kafka_timestamp": ("timestamp", None),
}


def raw_projection(records: DataFrame) -> DataFrame:
    """The message as received, with its place in the log."""
    given = {name: F.col(source) for name, (source, _) in RAW_COLUMNS.items()}
    return records.select(*[
        (value.cast(RAW_COLUMNS[name][1]) if RAW_COLUMNS[name][1] else value).alias(name) for name, value in given.items()
    ])


def parse_events(records: DataFrame) -> DataFrame:
    """JSON events to the flat typed table.

    Text that is not an event gives a row of nulls and an unreadable time gives
    a null time; the quality checks report both, the stream goes on.
    """
    text = F.col("value").cast("string")
    return records.select(F.from_json(text, contract.event_schema()).alias("event")).select(*contract.from_event("event"))


def checked_batch_writer(
    silver_path: str, log_path: str, suite: list[Expectation] | None = None, fmt: str = "parquet"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step: write the batch, check it, log the outcome.

    Checks inform and never hold a batch back. The suite is built once. An empty
    batch writes and logs nothing.
    """
    checks = Suite(silver_suite() if suite is None else suite, list(contract.SILVER_COLUMNS))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read once: the write and the checks both need it.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            stream = stream_id(batch)
            write_batch(batch, silver_path, batch_id, ["attack_type"], fmt, "silver", stream)
            record = batch_record(checks.validate(batch).collect(), batch_id)
            log = spark.createDataFrame([record], LOG_SCHEMA)
            log = log if fmt == "delta" else log.drop("batch_id")
            write_batch(log, log_path, batch_id, fmt=fmt, app="quality_log", stream=stream)
        finally:
            batch.unpersist()

    return step


def quarantine_schema() -> T.StructType:
    return contract.silver_schema().add("broken_rules", T.ArrayType(T.StringType())).add("valid", T.BooleanType())


def quarantine_batch_writer(path: str, suite: list[Expectation] | None = None, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` step that keeps rows which break a rule apart from the others.

    Every row gets the names of the rules it breaks. Valid and invalid rows are two partitions of one
    batch, written in one pass and committed by one manifest: after a crash or a replay each row is on
    one side, once."""
    checks = silver_suite() if suite is None else suite

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        judged = batch.withColumn("broken_rules", broken_rules(checks, batch.columns))
        write_batch(judged.withColumn("valid", F.size("broken_rules") == 0), path, batch_id, ["valid", "attack_type"], fmt, "quarantine", stream_id(batch))

    return step


def start_quarantine_sink(
    records: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds",
    suite: list[Expectation] | None = None, fmt: str = "parquet",
) -> StreamingQuery:
    """Parse every micro-batch and store it with invalid rows set apart."""
    return (
        parse_events(records).writeStream.outputMode("append").foreachBatch(quarantine_batch_writer(path, suite, fmt))
        .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()
    )


def read_valid(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    rows = read_batches(spark, path, quarantine_schema(), fmt).filter("valid")
    return rows.select(*[F.col(f"`{c}`") for c in contract.SILVER_COLUMNS])


def read_quarantine(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The invalid rows with the rules that they break."""
    rows = read_batches(spark, path, quarantine_schema(), fmt).filter("NOT valid")
    return rows.select(*[F.col(f"`{c}`") for c in contract.SILVER_COLUMNS], "broken_rules")


# ---- ids over all batches ----------------------------------------------------

REPEATED = "event_id string, first_seen timestamp, seen_again timestamp, batch_rows bigint"


#: Ids are watched in so many groups by hash. It is part of what a checkpoint holds: another number needs a new one.
ID_GROUPS = 512


def _watch_ids(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The ids of a group: remembered from their first row, reported when they come again, forgotten with the watermark."""
    watermark = state.getCurrentWatermarkMs()
    columns = {"first": "int64", "last": "int64", "until": "int64", "logged": "bool"}
    held = pd.DataFrame({"event_id": pd.Series(dtype=object)} | {c: pd.Series(dtype=kind) for c, kind in columns.items()})
    if state.exists:
        held = pa.ipc.open_stream(state.get[0]).read_pandas()
    held = held.set_index("event_id")
    sums = [] if state.hasTimedOut else [b.groupby("event_id")["seen"].agg(["min", "max", "size"]) for b in batches if len(b)]
    # An id is forgotten in the first batch without it after its time.
    stays = held["until"] >= watermark
    if sums:
        found = pd.concat(sums).groupby(level=0).agg({"min": "min", "max": "max", "size": "sum"})
        earliest, latest = (found[c].astype("datetime64[ns]").astype("int64") for c in ("min", "max"))
        place = held.index.get_indexer(found.index)
        known = place >= 0
        # Times are whole numbers throughout: as floating-point numbers they would lose microseconds.
        old = lambda name, new: np.where(known, held[name].to_numpy()[place], new) if len(held) else new
        first, last = old("first", earliest.to_numpy()), np.maximum(old("last", latest.to_numpy()), latest.to_numpy())
        logged = old("logged", np.zeros(len(found), bool))
        again = known | (found["size"].to_numpy() > 1)
        new = again & ~logged
        if new.any():
            yield pd.DataFrame({
                "event_id": found.index[new], "first_seen": pd.to_datetime(first[new]), "seen_again": pd.to_datetime(latest.to_numpy()[new]),
                "batch_rows": found["size"].to_numpy()[new],
            })
        until = np.maximum(last // 1_000_000, watermark) + 1
        now = pd.DataFrame({"first": first, "last": last, "until": until, "logged": logged | again}, index=found.index)
        held = pd.concat([held[stays & ~held.index.isin(found.index)], now])
    else:
        held = held[stays]
    if not len(held):
        state.remove()
        return
    out = pa.BufferOutputStream()
    table = pa.Table.from_pandas(held.rename_axis("event_id").reset_index().astype(columns), preserve_index=False)
    with pa.ipc.new_stream(out, table.schema) as stream:
        stream.write_table(table)
    state.update((out.getvalue().to_pybytes(),))
    state.setTimeoutTimestamp(int(held["until"].min()))


def repeated_ids(flows: DataFrame, delay: str = "1 day", time: str = "ingestion_timestamp") -> DataFrame:
    """Ids that come more than once in a stream, in one batch or in several: one row when an id is first seen again.

    Of each id the first and last time and whether it was reported are remembered, until the watermark, ``delay``
    behind the latest time, has passed it. Rows without an id or time are not looked at. The state is kept by groups of ids, as a
    call per id costs milliseconds; a batch rewrites the groups that its ids fall in."""
    seen = flows.select("event_id", F.col(time).cast("timestamp").alias("seen")).filter("event_id IS NOT NULL AND seen IS NOT NULL")
    seen = seen.withColumn("id_group", F.pmod(F.xxhash64("event_id"), F.lit(ID_GROUPS)).cast("int"))
    return seen.withWatermark("seen", delay).groupBy("id_group").applyInPandasWithState(
        _watch_ids, REPEATED, "ids binary", "append", GroupStateTimeout.EventTimeTimeout
    )


def start_id_watch(
    records: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds", delay: str = "1 day", fmt: str = "parquet",
) -> StreamingQuery:
    """Log repeated ids as batches; the state is part of the checkpoint, so a restart reports none twice."""

    def step(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_batch(batch, path, batch_id, fmt=fmt, app="repeated_ids", stream=stream_id(batch))

    return (
        repeated_ids(parse_events(records), delay).writeStream.outputMode("append").foreachBatch(step)
        .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()
    )


def read_repeated_ids(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    schema = T._parse_datatype_string(REPEATED)
    return read_batches(spark, path, schema, fmt).select(*schema.names)


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def start_raw_sink(
    records: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds", fmt: str = "parquet"
) -> StreamingQuery:
    """Append messages as received. Without an interval it takes what is there and stops."""
    # Raw messages are mostly text, which zstd stores in half the space.
    packed = {"compression": "zstd"} if fmt == "parquet" else {}
    return (
        raw_projection(records).writeStream.format(fmt).outputMode("append").options(**packed)
        .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start(path)
    )


def start_silver_sink(
    records: DataFrame, silver_path: str, log_path: str, checkpoint: str,
    interval: str | None = "10 seconds", suite: list[Expectation] | None = None, fmt: str = "parquet",
) -> StreamingQuery:
    """Parse, write and check every micro-batch."""
    return (
        parse_events(records).writeStream.outputMode("append")
        .foreachBatch(checked_batch_writer(silver_path, log_path, suite, fmt))
        .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()
    )


def start_ingestion(
    records: DataFrame, root: str, interval: str | None = "10 seconds", fmt: str = "parquet"
) -> list[StreamingQuery]:
    """Both sinks on one source, each with its own progress."""
    return [
        start_raw_sink(records, f"{root}/bronze", f"{root}/_progress/bronze", interval, fmt),
        start_silver_sink(
            records, f"{root}/silver", f"{root}/quality_log", f"{root}/_progress/silver", interval, fmt=fmt
        ),
    ]


def finish(queries: list[StreamingQuery], seconds: int = 10) -> None:
    """Wait for queries that stop by themselves; the first failure of any of them stops the others."""
    try:
        while any(query.isActive for query in queries):
            failed = [query for query in queries if not query.isActive and query.exception() is not None]
            if failed:
                break
            await_any(seconds)
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def await_any(seconds: int) -> None:
    """Wait until a stream of the session ends, for so long at most; how it ended is asked of the stream itself."""
    streams = SparkSession.active().streams
    streams.resetTerminated()
    try:
        streams.awaitAnyTermination(seconds)
    except StreamingQueryException:
        pass


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The committed rows of the parsed table in contract column order."""
    return read_batches(spark, path, contract.silver_schema(), fmt).select(*[F.col(f"`{c}`") for c in contract.SILVER_COLUMNS])


def read_quality_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_batches(spark, path, LOG_SCHEMA, fmt).select(*LOG_SCHEMA.fieldNames())
