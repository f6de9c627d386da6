"""Sources, sinks and streams. Each query writes to its own scratch folder and returns what was stored."""

import math

from pyspark.sql import functions as F

from flowlake import contract
from flowlake.operators import sampling
from flowlake.operators.score import score_with
from flowlake.registry.core import ALERTS_SQL, SCORED_SQL, add_rule_score, flows_of, on_flows, plain_times, query, rounded
from flowlake.sources import batches, readers, tables, writers
from flowlake.streaming import gold, ingest

#: Events in a file of the topic.
FILE_EVENTS = 50_000
EVENT_ID = "concat('evt_00000000_', substr(sha256(concat(schema_version, chr(31), CAST(row_id AS varchar))), 1, 24))"
SILVER = on_flows(
    f"SELECT {EVENT_ID} AS event_id, "
    + "ingestion_timestamp, schema_version, "
    + ", ".join(f'"{c}"' for c in (*contract.FEATURE_NAMES, *contract.INDICATORS, *contract.SILVER_LABELS))
    + " FROM flows"
)


def _events(t, flows=None):
    """The flows as JSON events, as a producer would send them."""
    spaced = (t.flows if flows is None else flows).withColumnsRenamed({v: k for k, v in contract.LABEL_RENAMES.items()})
    return writers.as_events(spaced, F.col("ingestion_timestamp"), content=[F.col("row_id")])


def as_records(events):
    """Events with the columns that a message log adds, for files that stand for one."""
    return events.select(
        "key", "value",
        F.lit("flows-raw").alias("topic"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def _published(t):
    """The events in files that look like a message log, several files for several micro-batches.

    There is a file per ``FILE_EVENTS`` events, so that no task's share grows with the table. Rows are dealt out by
    their id, of which the key is a digest, before they become text; the text is stored compressed."""
    path, files = t.scratch("topic"), max(4, math.ceil(t.events.count() / FILE_EVENTS))
    flows = flows_of(t.spark, t.events.repartition(files, "event_id"))
    as_records(_events(t, flows)).write.option("compression", "gzip").json(path)
    return path


def _capture(t):
    """The flows as a raw capture: all 52 columns with the original names."""
    spaced = t.flows.drop("Seq").withColumnsRenamed({v: k for k, v in contract.LABEL_RENAMES.items()})
    extra = {"Unnamed: 0": F.col("row_id"), "Seq": F.col("row_id") % 100, "Offset": F.col("row_id") * 10}
    extra |= {name: F.col("Dur") for name in ("RunTime", "Mean", "Sum", "Min", "Max")}
    extra |= {name: F.lit(610.0) for name in ("sVid", "dVid")}
    return spaced.withColumns(extra).select(*[F.col(f"`{c}`") for c in contract.raw_columns()])


RAW = on_flows(
    "SELECT " + ", ".join(f'"{c}"' for c in contract.FEATURE_NAMES)
    + ', "Label", attack_type AS "Attack Type", attack_tool AS "Attack Tool" FROM flows'
)


@query("s1_csv_scan", RAW)
def _(t):
    path = t.scratch("capture")
    _capture(t).write.option("header", True).csv(path)
    return contract.drop_contract_columns(readers.read_capture(t.spark, path), strict=True)


@query("s1_mixed_headers", RAW)
def _(t):
    """Two files of one capture with their columns in another order."""
    path = t.scratch("mixed")
    whole = _capture(t)
    whole.filter("`Unnamed: 0` % 2 = 0").write.option("header", True).csv(path)
    turned = whole.select(*[F.col(f"`{c}`") for c in reversed(whole.columns)])
    turned.filter("`Unnamed: 0` % 2 = 1").write.mode("append").option("header", True).csv(path)
    return contract.drop_contract_columns(readers.read_capture(t.spark, path), strict=True)


@query("s2_parquet_scan", "SELECT * FROM events")
def _(t):
    return readers.read_table(t.spark, f"{t.folder}/events.parquet")


@query("s3_event_stream", on_flows("""SELECT 'flows-raw' AS topic, count(*) AS events, count(*) AS keys FROM flows"""))
def _(t):
    path, out = _published(t), t.scratch("copy")
    stream = readers.event_stream(t.spark, "json", path)
    ingest.finish([ingest.start_raw_sink(stream, f"{out}/data", f"{out}/progress", None)])
    stored = t.spark.read.parquet(f"{out}/data")
    return stored.groupBy("topic").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("kafka_key").alias("keys")
    )


@query(
    "s4_table_stream",
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1",
)
def _(t):
    out = t.scratch("followed")
    # A pattern, so that the table may be one file or a folder.
    stream = readers.table_stream(t.spark, f"{t.folder}/events.parquet*", "parquet", t.events.schema)
    ingest.finish(
        [
            stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/progress")
            .trigger(availableNow=True).start(f"{out}/data")
        ]
    )
    stored = t.spark.read.parquet(f"{out}/data")
    return rounded(stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), 4)


ORDER = "md5(concat(event_id, '|42'))"


@query(
    "s6_sampled_scan",
    on_flows(f"SELECT event_id FROM flows ORDER BY {ORDER}, event_id LIMIT 1000"),
)
def _(t):
    return readers.read_sample(t.flows.select("event_id"), 1000)


@query(
    "s7_publish_events",
    on_flows(f"""SELECT {EVENT_ID} AS key,
      "Proto" AS proto, CAST("TotPkts" AS varchar) AS packets, attack_type, schema_version FROM flows"""),
)
def _(t):
    value = lambda path: F.get_json_object("value", path)
    return _events(t).select(
        "key", value("$.flow.Proto").alias("proto"), value("$.flow.TotPkts").alias("packets"),
        value("$.flow['Attack Type']").alias("attack_type"), value("$.schema_version").alias("schema_version"),
    )


@query("p2_bronze_projection", """SELECT CAST(event_id AS varchar) AS kafka_key, '{"user":' || user_id || '}' AS raw_json,
      'flows-' || event_type AS topic, CAST(event_id % 4 AS integer) AS partition, event_id AS "offset", ts AS kafka_timestamp FROM events""")
def _(t):
    records = t.events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.concat(F.lit('{"user":'), F.col("user_id"), F.lit("}")).cast("binary").alias("value"),
        F.concat(F.lit("flows-"), "event_type").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )
    return plain_times(ingest.raw_projection(records))


@query("p3_silver_parse", SILVER)
def _(t):
    return plain_times(ingest.parse_events(_events(t)))


def _ingested(t):
    """Both sinks on one source, run to the end of what is there."""

    def make():
        root = t.scratch("lake")
        ingest.finish(ingest.start_ingestion(readers.event_stream(t.spark, "json", _published(t)), root, None))
        return root

    return t.kept("lake", make)


@query("s9_silver_stream", SILVER)
def _(t):
    return plain_times(ingest.read_silver(t.spark, f"{_ingested(t)}/silver"))


@query("s8_bronze_stream", on_flows("SELECT 'flows-raw' AS topic, count(*) AS events FROM flows"))
def _(t):
    stored = t.spark.read.parquet(f"{_ingested(t)}/bronze")
    return stored.groupBy("topic").agg(F.count(F.lit(1)).alias("events"))


@query(
    "t1_two_sinks_agree",
    on_flows("SELECT count(*) AS raw_events, count(*) AS parsed_flows, count(*) AS in_both FROM flows"),
)
def _(t):
    root = _ingested(t)
    raw = t.spark.read.parquet(f"{root}/bronze").select(F.col("kafka_key").alias("event_id"), F.lit(1).alias("raw"))
    flows = ingest.read_silver(t.spark, f"{root}/silver").select("event_id", F.lit(1).alias("parsed"))
    return raw.join(flows, "event_id", "full").agg(
        F.count("raw").alias("raw_events"), F.count("parsed").alias("parsed_flows"),
        F.count_if(F.col("raw").isNotNull() & F.col("parsed").isNotNull()).alias("in_both"),
    )


@query(
    "t4_quality_log_stream",
    on_flows("""SELECT count(*) AS rows_validated, true AS all_passed, CAST(0 AS bigint) AS failed_expectations FROM flows"""),
)
def _(t):
    log = ingest.read_quality_log(t.spark, f"{_ingested(t)}/quality_log")
    return log.agg(
        F.sum("row_count").alias("rows_validated"), F.min("success").alias("all_passed"),
        F.sum("n_failed_expectations").alias("failed_expectations"),
    )


@query(
    "s10_quality_log_sink",
    on_flows("""SELECT CAST(count(*) AS bigint) AS row_count, false AS success, CAST(1 AS bigint) AS n_failed_expectations,
      'expect_column_values_to_be_between(Dur)' AS failed_expectation_summary FROM flows"""),
)
def _(t):
    root = t.scratch("checked")
    step = ingest.checked_batch_writer(f"{root}/silver", f"{root}/log")
    negative = t.flows.drop("row_id", "Seq").withColumn("Dur", -F.col("Dur") - 1)
    step(negative, 0)
    step(negative, 0)  # a replay of the batch leaves one log row
    step(negative.filter("false"), 1)  # an empty batch leaves none
    return ingest.read_quality_log(t.spark, f"{root}/log").select(
        "row_count", "success", "n_failed_expectations", "failed_expectation_summary"
    )


def _score(t, root, checkpoint="progress"):
    step = gold.scoring_batch_writer(add_rule_score, f"{root}/predictions", f"{root}/alerts")
    ingest.finish([gold.start_follower(t.spark, f"{root}/silver", step, f"{root}/{checkpoint}", max_batches=1)])


def _scored_stream(t):
    """The parsed table followed as a stream and scored by the fixed rule."""

    def make():
        root = t.scratch("gold")
        flows = t.flows.drop("row_id", "Seq")
        batches.write_batch(flows.filter("is_tcp = 1"), f"{root}/silver", 0, ["attack_type"])
        batches.write_batch(flows.filter("is_tcp = 0"), f"{root}/silver", 1, ["attack_type"])
        _score(t, root)
        return root

    return t.kept("gold", make)


@query(
    "s11_predictions_sink",
    on_flows(SCORED_SQL + """SELECT event_id, predicted_class, CAST(probability AS float) AS probability, model_version,
      ingestion_timestamp AS flow_timestamp FROM scored"""),
)
def _(t):
    stored = gold.read_predictions(t.spark, f"{_scored_stream(t)}/predictions")
    return plain_times(stored.drop("prediction_timestamp"))


@query(
    "s12_alerts_sink",
    on_flows(ALERTS_SQL + """SELECT event_id, predicted_class, CAST(probability AS float) AS probability, model_version,
      severity, flow_timestamp FROM alerts"""),
)
def _(t):
    stored = gold.read_alerts(t.spark, f"{_scored_stream(t)}/alerts")
    return plain_times(stored.drop("prediction_timestamp"))


@query(
    "t6_two_clocks",
    on_flows("SELECT count(*) AS predictions, count(*) AS scored_after_flow FROM flows"),
)
def _(t):
    stored = gold.read_predictions(t.spark, f"{_scored_stream(t)}/predictions")
    return stored.agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count_if(F.col("prediction_timestamp") > F.col("flow_timestamp")).alias("scored_after_flow"),
    )


@query(
    "t8_replayed_batch",
    on_flows("SELECT count(*) AS predictions, count(*) AS ids, count(*) AS flows FROM flows"),
)
def _(t):
    """A batch is stored and scored, stored again, as a restart does, and scored again, also from a new checkpoint."""
    root, flows = t.scratch("replayed"), t.flows.drop("row_id", "Seq")
    for checkpoint in ("progress", "progress", "progress-2"):
        batches.write_batch(flows, f"{root}/silver", 0, ["attack_type"])
        _score(t, root, checkpoint)
    stored = gold.read_predictions(t.spark, f"{root}/predictions").agg(
        F.count(F.lit(1)).alias("predictions"), F.count_distinct("event_id").alias("ids")
    )
    return stored.crossJoin(ingest.read_silver(t.spark, f"{root}/silver").agg(F.count(F.lit(1)).alias("flows")))


@query(
    "t8_new_checkpoint",
    on_flows("SELECT count(*) AS flows, count(*) AS ids, CAST(2 AS bigint) AS streams FROM flows"),
)
def _(t):
    """Two streams with checkpoints of their own store their batches 0 in one table."""
    root = t.scratch("streams")
    for part in (0, 1):
        topic = f"{root}/topic{part}"
        as_records(_events(t).filter(F.pmod(F.xxhash64("key"), F.lit(2)) == part)).write.json(topic)
        records = readers.event_stream(t.spark, "json", topic)
        ingest.finish([ingest.start_silver_sink(records, f"{root}/silver", f"{root}/log", f"{root}/progress{part}", None)])
    stored = t.spark.read.parquet(f"{root}/silver")
    return stored.agg(
        F.count(F.lit(1)).alias("flows"), F.count_distinct("event_id").alias("ids"), F.count_distinct("stream_id").alias("streams")
    )


@query(
    "t8_merged_table",
    on_flows("SELECT attack_type, count(*) AS flows, count(*) AS ids FROM flows GROUP BY 1"),
)
def _(t):
    """Batches come in before, between and after two merges; what was merged is removed from its own folders."""
    root, flows = t.scratch("merged"), t.flows.drop("row_id", "Seq")
    part = lambda k: flows.filter(F.pmod(F.xxhash64("event_id"), F.lit(5)) == k)
    merge = lambda fold=False: batches.merge_batches(t.spark, root, contract.silver_schema(), ["attack_type"], fold=fold)
    for k in range(5):
        batches.write_batch(part(k), root, k, ["attack_type"])
        if k in (1, 3):
            merge(fold=k == 3)
    batches.write_batch(part(0), root, 0, ["attack_type"])  # a replay of a merged batch
    batches.remove_merged(t.spark, root, keep=0)
    stored = ingest.read_silver(t.spark, root)
    return stored.groupBy("attack_type").agg(F.count(F.lit(1)).alias("flows"), F.count_distinct("event_id").alias("ids"))


@query("t5_stream_scoring")
def _(t):
    from flowlake.registry.model_checks import _forest

    root = t.scratch("model-gold")
    silver = _scored_stream(t)
    ingest.finish([gold.start_scoring(t.spark, f"{silver}/silver", _forest(t), root)])
    return gold.read_predictions(t.spark, f"{root}/predictions")


@query(
    "t10_pandas_scorer",
    on_flows("""SELECT event_id, CASE WHEN "Dur" > 2 THEN 'slow' ELSE 'fast' END AS predicted_class FROM flows"""),
)
def _(t):
    def scorer(batch):
        import numpy as np

        return batch.assign(predicted_class=np.where(batch["Dur"] > 2, "slow", "fast"))[["event_id", "predicted_class"]]

    return score_with(t.flows.select("event_id", "Dur"), scorer, "event_id string, predicted_class string")


@query(
    "s13_warehouse_load",
    on_flows("""SELECT attack_type, 2 * count(*) AS rows_loaded, 2 * count(*) AS stamped FROM flows GROUP BY 1"""),
)
def _(t):
    name = "load_" + t.scratch("t").rsplit("-", 1)[-1]
    path = t.scratch("warehouse")
    flows = t.flows.drop("row_id", "Seq")
    t.spark.sql(f"CREATE TABLE {name} ({tables.TABLES['silver_flows']}) USING parquet LOCATION '{path}'")
    writers.load_warehouse(flows, name)
    writers.load_warehouse(flows, name, truncate=True)
    writers.load_warehouse(flows, name)
    writers.load_warehouse(flows.filter("false"), name, truncate=True)  # nothing to load, nothing is emptied
    return t.spark.table(name).groupBy("attack_type").agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.count("loaded_at").alias("stamped")
    )


@query(
    "s14_full_refresh",
    on_flows("SELECT attack_type, count(*) AS flows FROM flows GROUP BY 1"),
)
def _(t):
    name = "refresh_" + t.scratch("t").rsplit("-", 1)[-1]
    path = t.scratch("refreshed")
    counts = t.flows.groupBy("attack_type").agg(F.count(F.lit(1)).alias("flows"))
    writers.refresh_table(counts.filter("attack_type = 'Benign'"), name, path=path)
    writers.refresh_table(counts, name, path=path)
    return t.spark.table(name)


@query(
    "s15_cache_or_build",
    on_flows('SELECT event_id, CAST("TotPkts" AS double) AS "TotPkts", CAST(is_tcp AS double) AS is_tcp FROM flows'),
)
def _(t):
    from flowlake.registry.model_checks import _encoder

    root = t.scratch("cache")
    build = lambda: _encoder(t).transform(t.flows, ["event_id"])
    readers.load_or_build(t.spark, root, build, engineer=False)
    again = readers.load_or_build(t.spark, root, _never, engineer=False)
    return again.select("event_id", "TotPkts", "is_tcp")


def _never():
    raise AssertionError("the cached table should have been read")


SPLIT = f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY attack_type ORDER BY {ORDER}, event_id) AS r,
    count(*) OVER (PARTITION BY attack_type) AS n FROM flows)
  SELECT event_id, attack_type FROM ranked WHERE r > (n * 70 + 50) // 100 AND r <= (n * 85 + 50) // 100
"""


@query("s16_split_table", on_flows(SPLIT))
def _(t):
    path = t.scratch("splits")
    split = sampling.stratified_split(t.flows.select("event_id", "attack_type"), "attack_type", "event_id")
    writers.save_splits(split, path)
    return writers.load_split(t.spark, path, "val")


@query(
    "s20_created_table",
    on_flows('SELECT event_id, "Proto", "TotBytes" FROM flows'),
)
def _(t):
    name = "ddl_" + t.scratch("t").rsplit("-", 1)[-1]
    path = t.scratch("ddl")
    t.spark.sql(f"{contract.table_ddl(name)} LOCATION '{path}'")
    writers.load_warehouse(t.flows.drop("row_id", "Seq"), name)
    return t.spark.table(name).select("event_id", "Proto", "TotBytes")


@query(
    "s21_staging_view",
    on_flows('SELECT event_id, "Dur" AS dur, "Proto" AS proto, "Label" AS label FROM flows'),
)
def _(t):
    name = "source_" + t.scratch("t").rsplit("-", 1)[-1]
    t.flows.createOrReplaceTempView(name)
    return t.spark.sql(contract.staging_sql(name)).select("event_id", "dur", "proto", "label")


