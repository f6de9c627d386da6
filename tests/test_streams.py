import json

import pytest
from pyspark.sql import functions as F

from flowlake import contract
from flowlake.operators.quality import Expectation, NOT_NULL, silver_suite, validate
from flowlake.registry.core import add_rule_score
from flowlake.sources import batches, readers, writers
from flowlake.streaming import gold, ingest


def event(number, **changes):
    flow = {f.name: {"float": 1.5, "int": 3, "category": "tcp"}[f.kind] for f in contract.FEATURES}
    flow |= {"Cause": "Start", "Label": "Benign", "Attack Type": "Benign", "Attack Tool": "Benign", "is_tcp": 1, "has_dst_reply": 1}
    flow |= changes.pop("flow", {})
    return {"event_id": f"e{number}", "ingestion_timestamp": "2024-01-05T10:00:00.000+00:00", "schema_version": "1.0.1", "flow": flow} | changes


def records(spark, values):
    rows = [(str(i), v if isinstance(v, str) else json.dumps(v), "flows-raw", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long").withColumn(
        "timestamp", F.current_timestamp()
    )


def publish(spark, path, values, files=1):
    records(spark, values).repartition(files).write.mode("append").json(path)


def test_parse_edge_events(spark):
    nulls = {f.name: None for f in contract.FEATURES if f.nullable}
    parsed = ingest.parse_events(
        records(
            spark,
            [
                event(0), event(1, flow=nulls), event(2, flow={"TotPkts": 3.5}), {"event_id": "e3"}, "not json",
                event(5, ingestion_timestamp="yesterday"),
            ],
        )
    )
    assert parsed.columns == list(contract.SILVER_COLUMNS)
    rows = parsed.collect()
    assert rows[0]["Dur"] == 1.5 and rows[0]["attack_type"] == "Benign" and rows[0]["ingestion_timestamp"].hour == 10
    assert rows[1]["dTtl"] is None and rows[1]["TotPkts"] == 3
    assert rows[2]["TotPkts"] is None  # not an integer
    assert rows[3]["event_id"] == "e3" and rows[3]["Dur"] is None
    assert rows[4]["event_id"] is None and rows[4]["attack_type"] is None
    assert rows[5]["event_id"] == "e5" and rows[5]["ingestion_timestamp"] is None


def test_round_trip_of_events(spark, flows):
    spaced = flows.withColumnsRenamed({v: k for k, v in contract.LABEL_RENAMES.items()}).withColumn("n", F.substring("event_id", 5, 8).cast("long"))
    events = writers.as_events(spaced, F.col("ingestion_timestamp"), F.col("n"))
    parsed = ingest.parse_events(events)
    keys = ["Dur", "dTtl", "TotBytes", "Proto", "attack_type", "ingestion_timestamp", "is_tcp"]
    assert parsed.select(keys).exceptAll(flows.select(keys)).count() == 0 and parsed.count() == flows.count()
    again = writers.as_events(spaced, F.col("ingestion_timestamp"), F.col("n"))
    assert events.select("key").exceptAll(again.select("key")).count() == 0
    text = events.first()["value"]
    assert set(json.loads(text)["flow"]) == {f.name for f in contract.flow_schema()}  # nulls are written


def test_nan_is_published_as_null(spark, flows):
    odd = flows.limit(1).withColumn("Dur", F.lit(float("nan"))).withColumn("Rate", F.lit(float("inf")))
    spaced = odd.withColumnsRenamed({v: k for k, v in contract.LABEL_RENAMES.items()})
    flow = json.loads(writers.as_events(spaced).first()["value"])["flow"]
    assert flow["Dur"] is None and flow["Rate"] is None


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    publish(spark, f"{root}/topic", [event(i) for i in range(6)])
    publish(spark, f"{root}/topic", [event(i, flow={"Dur": -1.0, "Proto": "gre"}) for i in range(6, 9)] + ["junk"])
    stream = lambda: readers.event_stream(spark, "json", f"{root}/topic", max_files=1)
    ingest.finish(ingest.start_ingestion(stream(), root, None))
    return root, stream


def test_both_sinks_and_the_log(spark, lake):
    root, _ = lake
    assert spark.read.parquet(f"{root}/bronze").count() == 10
    silver = ingest.read_silver(spark, f"{root}/silver")
    assert silver.count() == 10 and silver.filter("attack_type IS NULL").count() == 1
    log = ingest.read_quality_log(spark, f"{root}/quality_log").orderBy("row_count").collect()
    assert [(r["row_count"], r["success"]) for r in log] == [(4, False), (6, True)]
    # The bad batch is in the table all the same.
    assert silver.filter("Dur < 0").count() == 3
    summary = log[0]["failed_expectation_summary"]
    assert log[0]["n_failed_expectations"] > 10 and summary.count(";") == log[0]["n_failed_expectations"] - 1
    assert log[0]["n_failed_expectations"] == validate(
        silver.filter("Dur < 0 OR Dur IS NULL"), silver_suite()
    ).filter("NOT success").count()


def test_restart_continues_without_repeats(spark, lake):
    root, stream = lake
    before = ingest.read_silver(spark, f"{root}/silver").count()
    ingest.finish(ingest.start_ingestion(stream(), root, None))
    assert ingest.read_silver(spark, f"{root}/silver").count() == before
    publish(spark, f"{root}/topic", [event(100)])
    ingest.finish(ingest.start_ingestion(stream(), root, None))
    assert ingest.read_silver(spark, f"{root}/silver").count() == before + 1
    assert spark.read.parquet(f"{root}/bronze").count() == before + 1


def test_replayed_and_empty_batches(spark, flows, tmp_path):
    step = ingest.checked_batch_writer(f"{tmp_path}/silver", f"{tmp_path}/log", [Expectation(NOT_NULL, "Dur")])
    part = flows.limit(50)
    for batch_id, batch in ((0, part), (1, flows.limit(20)), (0, part), (2, flows.limit(0))):
        step(batch, batch_id)
    assert ingest.read_silver(spark, f"{tmp_path}/silver").count() == 70
    log = ingest.read_quality_log(spark, f"{tmp_path}/log").orderBy("batch_id").collect()
    assert [(r["batch_id"], r["row_count"], r["success"]) for r in log] == [(0, 50, True), (1, 20, True)]


def test_table_is_partitioned_by_attack(spark, flows, tmp_path):
    batches.write_batch(flows, f"{tmp_path}/t", 3, ["attack_type"])
    plan = ingest.read_silver(spark, f"{tmp_path}/t").filter("attack_type = 'UDPFlood'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(attack_type" in plan


def test_scoring_stream_stores_matching_tables(spark, flows, tmp_path):
    root = str(tmp_path)
    batches.write_batch(flows, f"{root}/silver", 0, ["attack_type"])
    step = gold.scoring_batch_writer(add_rule_score, f"{root}/predictions", f"{root}/alerts")
    run = lambda name="progress": ingest.finish([gold.start_follower(spark, f"{root}/silver", step, f"{root}/{name}")])
    run()
    run()
    # The batch again, as after a restart, and a scoring that starts afresh.
    batches.write_batch(flows, f"{root}/silver", 0, ["attack_type"])
    run()
    run("progress-2")
    predictions, alerts = gold.read_predictions(spark, f"{root}/predictions"), gold.read_alerts(spark, f"{root}/alerts")
    assert predictions.count() == flows.count() == predictions.select("event_id").distinct().count()
    malicious = predictions.filter("predicted_class <> 'Benign'")
    assert alerts.count() == malicious.count()
    assert alerts.select("event_id").exceptAll(malicious.select("event_id")).count() == 0
    # Stream and batch agree.
    batch = add_rule_score(flows).select("event_id", "predicted_class")
    assert predictions.select("event_id", "predicted_class").exceptAll(batch).count() == 0


def test_batch_without_alerts_writes_none(spark, flows, tmp_path):
    benign = flows.filter("attack_type = 'Benign' AND (TotPkts - 1) % 5 >= 3")
    gold.scoring_batch_writer(add_rule_score, f"{tmp_path}/p", f"{tmp_path}/a")(benign, 0)
    assert gold.read_predictions(spark, f"{tmp_path}/p").count() == benign.count()
    assert readers.read_if_present(spark, f"{tmp_path}/a") is None


def test_published_files_grow_with_the_events(spark, folder, monkeypatch):
    """No file of the topic holds more than its share, equal keys lie in one file, and the rows are all there."""
    from flowlake.registry import stream_checks
    from flowlake.registry.core import Tables

    monkeypatch.setattr(stream_checks, "FILE_EVENTS", 50)
    t = Tables(spark, folder)
    t.events = t.events.limit(600).unionAll(t.events.limit(3))
    stored = spark.read.schema(readers.RECORD_SCHEMA).json(stream_checks._published(t)).withColumn("file", F.input_file_name())
    sizes = [r["count"] for r in stored.groupBy("file").count().collect()]
    assert len(sizes) > 10 and sum(sizes) == t.events.count() and max(sizes) < 120
    assert stored.groupBy("key").agg(F.count_distinct("file").alias("n")).filter("n > 1").count() == 0
    want = {r["value"] for r in stream_checks._events(t).collect()}
    assert {r["value"] for r in stored.select(F.col("value").cast("string").alias("value")).collect()} == want
