"""Dashboard queries on the marts and the stored result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.contract import ATTACK_TYPES, BINARY_LABELS


def _metrics(one_row: DataFrame, values: dict[str, Column]) -> DataFrame:
    rows = [F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items()]
    return one_row.select(F.inline(F.array(*rows)))


def since_latest(df: DataFrame, time: str, interval: str) -> DataFrame:
    """Rows of the last interval, counted back from the newest row."""
    newest = df.agg(F.max(time).alias("t")).scalar()
    return df.filter(F.col(time) >= newest - F.expr(f"INTERVAL {interval}"))


def _share(part: Column, whole: Column, scale: float = 100.0) -> Column:
    return F.round(F.when(whole > 0, F.lit(scale) * part / whole).otherwise(F.lit(0.0)), 2)


def overview(traffic: DataFrame, alerts: DataFrame) -> DataFrame:
    """Total flows, flows of the last 24 hours, malicious rate, alerts and high alerts."""
    malicious = F.sum(F.when(F.col("label") == "Malicious", F.col("flow_count")).otherwise(0))
    total = F.sum("flow_count")
    everything = _metrics(
        traffic.agg(total.alias("total"), malicious.alias("bad")),
        {"total_flows": F.col("total"), "malicious_rate_pct": _share(F.col("bad"), F.col("total"))},
    )
    day = _metrics(
        since_latest(traffic, "flow_hour", "24 HOURS").agg(total.alias("total")), {"flows_last_24h": F.col("total")}
    )
    raised = _metrics(
        alerts.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("severity") == "High").alias("high")),
        {"total_alerts": F.col("n"), "high_severity_alerts": F.col("high")},
    )
    return everything.unionByName(day).unionByName(raised)


def flows_over_time(traffic: DataFrame) -> DataFrame:
    """Benign and malicious flows per hour and the malicious share."""
    wide = (
        traffic.groupBy("flow_hour").pivot("label", list(BINARY_LABELS))
        .agg(F.sum("flow_count")).na.fill(0, list(BINARY_LABELS))
    )
    benign, bad = F.col("Benign"), F.col("Malicious")
    return wide.select(
        "flow_hour", benign.alias("benign_flows"), bad.alias("malicious_flows"),
        _share(bad, benign + bad).alias("malicious_rate_pct"),
    ).orderBy("flow_hour")


def attack_mix(traffic: DataFrame, by: str = "attack_type", interval: str | None = None) -> DataFrame:
    """Flows and share per attack type or category, all or of the last interval."""
    source = since_latest(traffic, "flow_hour", interval) if interval else traffic
    grouped = source.groupBy(by).agg(F.sum("flow_count").alias("flow_count"))
    return grouped.withColumn(
        "pct", _share(F.col("flow_count"), F.sum("flow_count").over(Window.partitionBy()))
    ).orderBy(F.desc("flow_count"), by)


def latest_critical(alerts: DataFrame, n: int = 10) -> DataFrame:
    """The newest high-severity alerts."""
    return alerts.filter(F.col("severity") == "High").orderBy(F.desc("flow_timestamp"), F.desc("event_id")).limit(n)


def attacks_over_time(traffic: DataFrame) -> DataFrame:
    """Attack flows per hour, one column per type."""
    types = [t for t in ATTACK_TYPES if t != "Benign"]
    return (
        traffic.filter(F.col("attack_type") != "Benign").groupBy("flow_hour").pivot("attack_type", types)
        .agg(F.sum("flow_count")).na.fill(0, types).orderBy("flow_hour")
    )


def families_over_time(traffic: DataFrame) -> DataFrame:
    """Denial-of-service against reconnaissance flows per hour."""
    families = ["DoS", "Reconnaissance"]
    return (
        traffic.filter(F.col("attack_category").isin(*families)).groupBy("flow_hour")
        .pivot("attack_category", families).agg(F.sum("flow_count")).na.fill(0, families).orderBy("flow_hour")
    )


def attacks_by_tool(summary: DataFrame) -> DataFrame:
    return (
        summary.filter(F.col("label") == "Malicious").groupBy("attack_tool")
        .agg(F.sum("flow_count").alias("flow_count"), F.sum("total_bytes").alias("total_bytes"))
        .orderBy(F.desc("flow_count"), "attack_tool")
    )


def attack_profile(summary: DataFrame) -> DataFrame:
    """Rate, duration and volume per attack type; averages are weighted by their flows."""
    flows = F.sum("flow_count")
    mean = lambda c: F.sum(F.col(c) * F.col("flow_count")) / flows
    return summary.groupBy("attack_type").agg(
        flows.alias("flow_count"), F.sum("total_bytes").alias("total_bytes"),
        mean("avg_rate").alias("avg_rate"), mean("avg_duration_seconds").alias("avg_duration_seconds"),
        F.count_distinct("attack_tool").alias("tools"),
    ).orderBy(F.desc("flow_count"), "attack_type")


def protocol_heatmap(breakdown: DataFrame) -> DataFrame:
    """Protocols against attack types."""
    types = list(ATTACK_TYPES)
    return (
        breakdown.groupBy("proto").pivot("attack_type", types).agg(F.sum("flow_count"))
        .na.fill(0, types).orderBy("proto")
    )


def protocol_by_hour(flows: DataFrame) -> DataFrame:
    """Hours against protocols; this one needs the flows, no mart has both."""
    return (
        flows.groupBy(F.date_trunc("hour", "ingestion_timestamp").alias("flow_hour"), "proto")
        .agg(F.count(F.lit(1)).alias("flow_count")).orderBy("flow_hour", "proto")
    )


def top_importance(importance: DataFrame, n: int = 10, of_class: str | None = None) -> DataFrame:
    """The n most important features overall or of one class."""
    return importance.filter(
        (F.col("class") == (of_class or "Overall")) & (F.col("feature_rank") <= n)
    ).orderBy("feature_rank")


def drift_verdict(drift: DataFrame) -> DataFrame:
    return drift.agg(
        F.count(F.lit(1)).alias("features"), F.sum("drifted").alias("drifted_features"),
        F.max("share_drifted").alias("share_drifted"),
        F.max("dataset_drift_detected").alias("dataset_drift_detected"),
    )


def top_drift(drift: DataFrame, n: int = 5) -> DataFrame:
    return drift.select("feature", "psi", "ks_statistic", "drifted").orderBy(F.desc("psi"), "feature").limit(n)


def model_card(performance: DataFrame) -> DataFrame:
    """Version and overall figures; they are the same on every row."""
    return performance.groupBy("model_version").agg(
        F.max("accuracy").alias("accuracy"), F.max("macro_f1").alias("macro_f1"),
        F.max("weighted_f1").alias("weighted_f1"), F.sum("support").alias("support"),
    )


def quality_totals(summary: DataFrame) -> DataFrame:
    """Pass rate over all batches, rows checked and failed checks."""
    passed, batches = F.sum("passed_batches"), F.sum("total_batches")
    return summary.agg(
        batches.alias("total_batches"), passed.alias("passed_batches"),
        _share(passed, batches).alias("pass_rate_pct"),
        F.sum("total_rows_validated").alias("total_rows_validated"),
        F.sum("total_failed_expectations").alias("total_failed_expectations"),
    )


def flagged_rates(scored: DataFrame) -> DataFrame:
    """Truly malicious share against the share that the model flags."""
    rate = lambda c: F.avg((F.col(c) != "Benign").cast("int"))
    return scored.agg(rate("attack_type").alias("true_rate"), rate("predicted_class").alias("flagged_rate"))
