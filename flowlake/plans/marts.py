"""The four marts that feed the dashboards.

Each mart aggregates first and joins the category lookup afterwards, so only a
few group rows meet the join and the flows themselves are shuffled once, as
partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from flowlake.operators.lookup import attack_categories


def staging_flows(silver: DataFrame) -> DataFrame:
    """Lower-case projection of parsed flows; drops load stamps and batch ids."""
    from flowlake.contract import staging_columns

    return silver.select(staging_columns())


def staging_quality_log(log: DataFrame) -> DataFrame:
    return log.select(
        "event_timestamp", "batch_id", "row_count", "success",
        "n_failed_expectations", "failed_expectation_summary",
    )


def with_category(df: DataFrame) -> DataFrame:
    """Left join to the nine-row category lookup; unknown types keep a null category."""
    return df.join(F.broadcast(attack_categories(df.sparkSession)), "attack_type", "left")


def attack_summary(flows: DataFrame) -> DataFrame:
    grouped = flows.groupBy("attack_type", "attack_tool", "label").agg(
        F.count(F.lit(1)).alias("flow_count"),
        F.sum("totbytes").alias("total_bytes"),
        F.avg("rate").alias("avg_rate"),
        F.avg("dur").alias("avg_duration_seconds"),
    )
    everything = Window.partitionBy()
    return (
        with_category(grouped)
        .select(
            "attack_type", "attack_category", "attack_tool", "label",
            "flow_count", "total_bytes", "avg_rate", "avg_duration_seconds",
            F.round(F.lit(100.0) * F.col("flow_count") / F.sum("flow_count").over(everything), 2)
            .alias("pct_of_total_flows"),
        )
        .orderBy(F.desc("flow_count"))
    )


def traffic_by_hour(flows: DataFrame) -> DataFrame:
    grouped = flows.groupBy(
        F.date_trunc("hour", "ingestion_timestamp").alias("flow_hour"), "label", "attack_type"
    ).agg(F.count(F.lit(1)).alias("flow_count"), F.sum("totbytes").alias("total_bytes"))
    return (
        with_category(grouped)
        .select("flow_hour", "label", "attack_type", "attack_category", "flow_count", "total_bytes")
        .orderBy("flow_hour", "label", "attack_type")
    )


def protocol_breakdown(flows: DataFrame) -> DataFrame:
    return (
        flows.groupBy("proto", "attack_type")
        .agg(
            F.count(F.lit(1)).alias("flow_count"),
            F.avg("totpkts").alias("avg_packets"),
            F.avg("smeanpktsz").alias("avg_src_packet_size"),
        )
        .orderBy("proto", F.desc("flow_count"))
    )


def quality_summary(log: DataFrame) -> DataFrame:
    # A null verdict counts as failed: it is not known to have passed.
    passed = F.count_if(F.col("success"))
    return (
        log.groupBy(F.date_trunc("hour", "event_timestamp").alias("batch_hour"))
        .agg(
            F.count(F.lit(1)).alias("total_batches"),
            passed.alias("passed_batches"),
            (F.count(F.lit(1)) - passed).alias("failed_batches"),
            F.round(F.lit(100.0) * passed / F.count(F.lit(1)), 2).alias("pass_rate_pct"),
            F.sum("row_count").alias("total_rows_validated"),
            F.sum("n_failed_expectations").alias("total_failed_expectations"),
        )
        .orderBy("batch_hour")
    )
