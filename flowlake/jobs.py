"""The jobs that an installation runs, as functions and as a command line.

A lake folder holds the stored layers::

    <lake>/bronze  <lake>/silver  <lake>/quality_log      written by ``ingest``
    <lake>/splits  <lake>/model                           written by ``train``
    <lake>/predictions  <lake>/alerts                     written by ``score``

Warehouse tables and marts are catalog tables of the session.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake import contract
from flowlake.operators import drift, evaluate, explain, features, quality, sampling, score, train
from flowlake.plans import marts
from flowlake.session import build_session
from flowlake.sources import batches, readers, tables, writers
from flowlake.streaming import gold, ingest

MODELS = {"logistic": train.fit_logistic, "forest": train.fit_forest, "boosted": train.fit_boosted}


def publish(spark: SparkSession, capture: str, limit: int | None = None, seed: int = 42, **sink) -> None:
    """Send a raw capture as events in a seeded order, all of it or the first rows of that order."""
    raw = readers.read_capture(spark, capture)
    # A capture has no id: it is made of the row and its number among equal rows.
    rows = writers.numbered(writers.prepare_replay(raw))
    events = writers.as_events(rows, number=F.col("__number"))
    events = sampling.shuffled_head(events, limit, "key", seed) if limit else sampling.shuffled(events, "key", seed)
    writers.publish(events, **sink)


def run_ingestion(
    spark: SparkSession, lake: str, interval: str | None = None, fmt: str = "kafka",
    table_format: str = "parquet", **source,
) -> None:
    """Follow the events into the raw and parsed tables; without an interval up to the present end."""
    stream = readers.event_stream(spark, fmt, **source)
    ingest.finish(ingest.start_ingestion(stream, lake, interval, table_format))


def check_table(spark: SparkSession, lake: str, fmt: str = "parquet") -> DataFrame:
    """The whole suite on the whole parsed table; ids are unique over all batches here."""
    return quality.validate(ingest.read_silver(spark, f"{lake}/silver", fmt), quality.silver_suite()).orderBy("position")


#: The stored layers: folder, schema and partition columns.
LAYERS = {
    "silver": (contract.silver_schema(), ["attack_type"]),
    "quality_log": (quality.LOG_SCHEMA, []),
    "predictions": (score.PREDICTIONS_SCHEMA, []),
    "alerts": (score.ALERTS_SCHEMA, []),
}


def merge_layers(spark: SparkSession, lake: str, fold: bool = False, keep: int | None = None) -> dict[str, bool]:
    """Merge the batches of every layer into large files; with ``keep`` remove what snapshots before these no longer need."""
    done = {}
    for name, (schema, partitions) in LAYERS.items():
        done[name] = batches.merge_batches(spark, f"{lake}/{name}", schema, partitions, fold=fold)
        if keep is not None:
            batches.remove_merged(spark, f"{lake}/{name}", keep)
    return done


def run_training(
    spark: SparkSession, lake: str, kind: str = "forest", version: str = "1", engineer: bool = False, fmt: str = "parquet", **options
):
    """Split, encode and train on the parsed table; store the splits and the model."""
    flows = ingest.read_silver(spark, f"{lake}/silver", fmt).filter(F.col("attack_type").isNotNull())
    encoder = features.FlowEncoder.fit(flows, engineer)
    matrix = encoder.transform(flows, ["event_id", "attack_type"])
    writers.save_splits(sampling.stratified_split(matrix, "attack_type", "event_id"), f"{lake}/splits")
    rows = train.with_balanced_weight(writers.load_split(spark, f"{lake}/splits", "train"), "attack_type")
    model = MODELS[kind](rows, encoder.columns, "attack_type", version=version, encoder=encoder, **options)
    model.save(spark, f"{lake}/model")
    return model


def run_scoring(spark: SparkSession, lake: str, interval: str | None = None, fmt: str = "parquet") -> None:
    """Score parsed flows that have not been scored yet and raise alerts."""
    model = train.Classifier.load(spark, f"{lake}/model")
    ingest.finish([gold.start_scoring(spark, f"{lake}/silver", model, lake, interval, fmt)])


def export_performance(spark: SparkSession, lake: str) -> None:
    """Test-set metrics of the stored model."""
    model = train.Classifier.load(spark, f"{lake}/model")
    scored = score.score_matrix(writers.load_split(spark, f"{lake}/splits", "test"), model)
    writers.refresh_table(
        evaluate.model_performance(scored, "attack_type", "predicted_class", model.version), "gold_model_performance"
    )


def export_importance(spark: SparkSession, lake: str) -> None:
    """Ranked contributions over the test set."""
    model = train.Classifier.load(spark, f"{lake}/model")
    writers.refresh_table(explain.global_importance(writers.load_split(spark, f"{lake}/splits", "test"), model), "gold_shap_global")


def export_drift(spark: SparkSession, lake: str) -> None:
    """Validation rows against all training rows."""
    model = train.Classifier.load(spark, f"{lake}/model")
    reference = writers.load_split(spark, f"{lake}/splits", "train")
    current = writers.load_split(spark, f"{lake}/splits", "val")
    writers.refresh_table(drift.drift_table(reference, current, model.features), "gold_drift")


def load_warehouse(spark: SparkSession, lake: str, truncate: bool = False, fmt: str = "parquet") -> None:
    """Load the stored layers into their tables; layers that do not exist yet are skipped."""
    tables.create_tables(spark, names=["silver_flows", "quality_log", "gold_model_predictions", "gold_security_alerts"])
    layers = {
        "silver_flows": ("silver", ingest.read_silver),
        "quality_log": ("quality_log", ingest.read_quality_log),
        "gold_model_predictions": ("predictions", gold.read_predictions),
        "gold_security_alerts": ("alerts", gold.read_alerts),
    }
    for table, (folder, read) in layers.items():
        path = f"{lake}/{folder}"
        if readers.read_if_present(spark, path, fmt) is not None:
            writers.load_warehouse(read(spark, path, fmt), table, truncate)


def build_marts(spark: SparkSession) -> DataFrame:
    """Staging views, mart tables, and the checks on both."""
    flows = marts.staging_flows(spark.table("silver_flows"))
    log = marts.staging_quality_log(spark.table("quality_log"))
    built = {
        "mart_attack_summary": marts.attack_summary(flows),
        "mart_traffic_by_hour": marts.traffic_by_hour(flows),
        "mart_protocol_breakdown": marts.protocol_breakdown(flows),
        "mart_quality_summary": marts.quality_summary(log),
    }
    tables.expose({"stg_flows": flows, "stg_quality_log": log}, built)
    return quality.schema_tests({"stg_flows": flows, **{name: spark.table(name) for name in built}})


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m flowlake.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str) -> argparse.ArgumentParser:
        return jobs.add_parser(name)

    sender = job("publish")
    sender.add_argument("capture")
    sender.add_argument("--limit", type=int)
    sender.add_argument("--seed", type=int, default=42)
    follower = job("ingest")
    follower.add_argument("lake")
    for one in (sender, follower):
        one.add_argument("--format", dest="fmt", default="kafka")
        one.add_argument("--path")
        one.add_argument("--servers")
        one.add_argument("--topic", default="flows-raw")
    follower.add_argument("--interval")
    for name in ("check", "train", "score", "performance", "importance", "drift", "load", "merge"):
        job(name).add_argument("lake")
    for name in ("ingest", "check", "train", "score", "load"):
        jobs.choices[name].add_argument("--table-format", default="parquet")
    jobs.choices["merge"].add_argument("--fold", action="store_true")
    jobs.choices["merge"].add_argument("--keep", type=int)
    jobs.choices["train"].add_argument("--kind", choices=MODELS, default="forest")
    jobs.choices["train"].add_argument("--version", default="1")
    jobs.choices["score"].add_argument("--interval")
    jobs.choices["load"].add_argument("--truncate", action="store_true")
    job("marts")
    chosen = parser.parse_args(arguments)

    spark = build_session("flowlake " + chosen.job)
    if chosen.job == "publish":
        publish(
            spark, chosen.capture, chosen.limit, chosen.seed,
            fmt=chosen.fmt, path=chosen.path, servers=chosen.servers, topic=chosen.topic,
        )
    elif chosen.job == "ingest":
        run_ingestion(
            spark, chosen.lake, chosen.interval, chosen.fmt, chosen.table_format,
            path=chosen.path, servers=chosen.servers, topic=chosen.topic,
        )
    elif chosen.job == "check":
        check_table(spark, chosen.lake, chosen.table_format).filter("NOT success").show(100, False)
    elif chosen.job == "train":
        run_training(spark, chosen.lake, chosen.kind, chosen.version, fmt=chosen.table_format)
    elif chosen.job == "score":
        run_scoring(spark, chosen.lake, chosen.interval, chosen.table_format)
    elif chosen.job == "load":
        load_warehouse(spark, chosen.lake, chosen.truncate, chosen.table_format)
    elif chosen.job == "merge":
        merge_layers(spark, chosen.lake, chosen.fold, chosen.keep)
    elif chosen.job == "marts":
        build_marts(spark).filter("NOT passed").show(100, False)
    else:
        {"performance": export_performance, "importance": export_importance, "drift": export_drift}[chosen.job](
            spark, chosen.lake
        )


if __name__ == "__main__":
    main()
