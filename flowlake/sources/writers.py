"""Sinks: events, warehouse tables and splits. Batches that may be replayed are in ``batches``."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowlake import contract
from flowlake.functions.scalar import event_id, finite, quoted


def prepare_replay(raw: DataFrame) -> DataFrame:
    """Raw capture rows as they are published: contract columns dropped, flags added."""
    from flowlake.operators.features import add_indicators

    return add_indicators(contract.drop_contract_columns(raw))


def numbered(rows: DataFrame, name: str = "__number") -> DataFrame:
    """Number equal rows from 0, whatever the layout of the input.

    Each part of the input numbers its own; the counts of the earlier parts are added. So
    a row that is repeated everywhere is no single group.
    """
    texts = [F.coalesce(quoted(c).cast("string"), F.lit("\x00")) for c in rows.columns]
    keyed = rows.withColumns({"__row": F.sha2(F.concat_ws("\x1f", *texts), 256), "__part": F.spark_partition_id()})
    counts = keyed.groupBy("__row", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__row").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).filter("__before > 0")
    own = Window.partitionBy("__row", "__part").orderBy("__row")
    found = keyed.withColumn("__own", F.row_number().over(own) - 1)
    found = found.join(counts.select("__row", "__part", "__before"), ["__row", "__part"], "left")
    return found.withColumn(name, F.col("__own") + F.coalesce("__before", F.lit(0))).select(*[quoted(c) for c in rows.columns], name)


def as_events(
    flows: DataFrame, stamp: Column | None = None, number: Column | None = None, content: list[Column] | None = None,
) -> DataFrame:
    """Wrap rows into keyed JSON events; NaN becomes null and nulls are written out.

    The id is a digest of the row (or of ``content``) with its ``number`` among equal rows;
    without a number equal rows share an id.
    """
    stamp = F.current_timestamp() if stamp is None else stamp
    columns = []
    for field in contract.flow_schema():
        value = quoted(field.name).cast(field.dataType)
        columns.append((finite(value) if field.dataType.typeName() == "double" else value).alias(field.name))
    marked = flows.select(
        event_id(F.lit(contract.SCHEMA_VERSION), *(columns if content is None else content), number=number).alias("event_id"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingestion_timestamp"),
        F.lit(contract.SCHEMA_VERSION).alias("schema_version"),
        F.struct(*columns).alias("flow"),
    )
    return marked.select(
        F.col("event_id").alias("key"),
        F.to_json(F.struct(*marked.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def publish(events: DataFrame, fmt: str = "kafka", path: str | None = None, servers: str | None = None,
            topic: str = "flows-raw") -> None:
    """Send keyed events to a topic, or to a folder of files with the keys and values."""
    if fmt == "kafka":
        (
            events.write.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("kafka.acks", "all").save()
        )
        return
    events.write.mode("append").format(fmt).save(path)


def load_warehouse(
    df: DataFrame | None, table: str, truncate: bool = False, stamp: bool = True, upper: bool = False,
    fmt: str = "parquet", jdbc: dict[str, str] | None = None, path: str | None = None,
) -> bool:
    """Load a table, appending or after emptying it; nothing is done without rows.

    Columns go by name into an existing table: one that the table lacks is an error,
    one that only the table has becomes null with a warning. With ``jdbc`` options the same
    load goes to a database.
    """
    if df is None or df.isEmpty():
        return False
    if upper:
        df = contract.upper_columns(df)
    if stamp:
        df = df.withColumn("LOADED_AT" if upper else "loaded_at", F.current_timestamp())
    if jdbc is not None:
        writer = df.write.format("jdbc").options(**jdbc).option("dbtable", table)
        if truncate:
            writer = writer.option("truncate", True)
        writer.mode("overwrite" if truncate else "append").save()
        return True
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.format(fmt).saveAsTable(table, **({"path": path} if path else {}))
        return True
    names = {name.lower(): name for name in df.columns}
    target = spark.table(table).columns
    unknown = sorted(names.keys() - {c.lower() for c in target})
    if unknown:
        raise ValueError(f"{table} has no columns {', '.join(unknown)}")
    missing = [c for c in target if c.lower() not in names]
    if missing:
        warnings.warn(f"{table}: no values for {', '.join(missing)}", stacklevel=2)
    aligned = df.select(
        [quoted(names[c.lower()]).alias(c) if c.lower() in names else F.lit(None).alias(c) for c in target]
    )
    aligned.write.insertInto(table, overwrite=truncate)
    return True


def refresh_table(df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Replace a derived table as a whole."""
    df.write.format(fmt).mode("overwrite").saveAsTable(table, **({"path": path} if path else {}))


def save_splits(split: DataFrame, path: str) -> None:
    """All splits in one table, one folder each."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One split; only its folder is read."""
    return spark.read.parquet(path).filter(F.col("split") == name).drop("split")
