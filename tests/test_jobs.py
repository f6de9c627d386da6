"""The whole chain from a raw capture to the marts."""

from flowlake import contract, jobs
from flowlake.plans import kpi
from flowlake.registry.stream_checks import _capture
from flowlake.streaming import gold, ingest


def test_capture_to_marts(spark, tables, tmp_path):
    lake, topic, capture = f"{tmp_path}/lake", f"{tmp_path}/topic", f"{tmp_path}/capture"
    _capture(tables).write.option("header", True).csv(capture)
    total = tables.flows.count()

    jobs.publish(spark, capture, fmt="json", path=topic)
    jobs.run_ingestion(spark, lake, fmt="json", path=topic, max_files=4)
    silver = ingest.read_silver(spark, f"{lake}/silver")
    assert silver.count() == total == silver.select("event_id").distinct().count()
    names = [*contract.FEATURE_NAMES, "Label", "attack_type"]
    assert silver.select(names).exceptAll(tables.flows.select(names)).count() == 0
    assert jobs.check_table(spark, lake).filter("NOT success").count() == 0

    model = jobs.run_training(spark, lake, "forest", version="3", trees=5, depth=6)
    jobs.run_scoring(spark, lake)
    predictions = gold.read_predictions(spark, f"{lake}/predictions")
    assert predictions.count() == total and predictions.select("model_version").distinct().first()[0] == "3"
    jobs.run_scoring(spark, lake)  # nothing new, nothing repeated
    assert gold.read_predictions(spark, f"{lake}/predictions").count() == total

    jobs.load_warehouse(spark, lake, truncate=True)
    tests = jobs.build_marts(spark)
    assert tests.count() == 18 and tests.filter("NOT passed").count() == 0
    assert spark.table("mart_attack_summary").selectExpr("sum(flow_count)").first()[0] == total
    cards = {r["metric"]: r["value"] for r in kpi.overview(spark.table("mart_traffic_by_hour"), spark.table("gold_security_alerts")).collect()}
    assert cards["total_flows"] == total
    assert cards["total_alerts"] == predictions.filter("predicted_class <> 'Benign'").count()

    jobs.export_performance(spark, lake)
    assert spark.table("gold_model_performance").selectExpr("sum(support)").first()[0] == spark.read.parquet(f"{lake}/splits").filter("split = 'test'").count()
    jobs.export_importance(spark, lake)
    assert spark.table("gold_shap_global").count() == len(model.features) * (len(model.classes) + 1)
    jobs.export_drift(spark, lake)
    assert kpi.drift_verdict(spark.table("gold_drift")).first()["features"] == len(model.features)


def keys_of(spark, capture, path, **options):
    jobs.publish(spark, capture, fmt="json", path=path, **options)
    return spark.read.json(path).select("key")


def test_ids_do_not_depend_on_the_layout(spark, tables, tmp_path):
    rows = _capture(tables)
    rows = rows.unionByName(rows.filter("`Unnamed: 0` % 7 = 0"))  # some rows come twice
    for name, parts in (("one", 1), ("many", 7)):
        rows.repartition(parts).write.option("header", True).csv(f"{tmp_path}/{name}")
    one, many = (keys_of(spark, f"{tmp_path}/{n}", f"{tmp_path}/{n}-events") for n in ("one", "many"))
    assert one.count() == rows.count() == one.distinct().count()
    assert one.exceptAll(many).count() == 0 == many.exceptAll(one).count()
    limited = [keys_of(spark, f"{tmp_path}/{n}", f"{tmp_path}/{n}-40", limit=40) for n in ("one", "many")]
    assert limited[0].count() == 40 and limited[0].exceptAll(limited[1]).count() == 0


def test_two_captures_share_no_ids(spark, tables, tmp_path):
    rows = _capture(tables)
    for part in (0, 1):
        rows.filter(f"`Unnamed: 0` % 2 = {part}").write.option("header", True).csv(f"{tmp_path}/{part}")
    first, second = (keys_of(spark, f"{tmp_path}/{p}", f"{tmp_path}/{p}-events") for p in (0, 1))
    assert first.intersect(second).count() == 0
