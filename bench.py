"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local cores.
Every result is computed in full and thrown away by the sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "a1_attack_summary", "a2_traffic_by_hour", "a3_protocol_breakdown", "a4_quality_summary",
    "b1_overview_cards", "b6_attack_profile", "b7_protocol_heatmap",
    "p3_silver_parse", "s1_csv_scan", "s9_silver_stream", "s11_predictions_sink",
    "q6_suite_on_faulty_flows", "q9_schema_tests",
    "m5_model_matrix", "k5_sample_per_class", "k7_stratified_split",
    "m17_threshold_sweep", "m18_class_report", "m19_binary_metrics",
    "m27_drift_table", "m28_column_drift",
    "a8_distinct_counts", "a14_exact_quantiles", "a16_duplicate_rows", "w3_segment_ids", "w5_label_blocks",
    "m10_logistic_regression", "m11_random_forest", "m12_boosted_classes", "m16_batch_scoring", "m22_global_importance", "m23_local_explanation",
]


def main() -> None:
    # Result lines only on stdout.
    out, sys.stdout = sys.stdout, sys.stderr
    from flowlake.registry import QUERIES
    from flowlake.session import build_session

    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name:32s} {times[name]:8.2f}", file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    rate = {
        name: round(events / times[name])
        for name in ("s9_silver_stream", "s11_predictions_sink", "m5_model_matrix", "m16_batch_scoring") if name in times
    }
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "events": events,
        "events_per_sec": rate,
    }
    print(json.dumps(result), file=out, flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
