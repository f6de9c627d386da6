"""Marts and the joins and windows inside them."""

from pyspark.sql import Window, functions as F

from flowlake.operators.lookup import join_predictions, without_prediction
from flowlake.plans import marts
from flowlake.registry.core import CATEGORY_SQL, LOG_SQL, SCORED_SQL, on_flows, plain_times, query, rounded

A1 = CATEGORY_SQL + """, by_attack AS (
  SELECT f.attack_type, c.attack_category, f.attack_tool, f."Label" AS label, count(*) AS flow_count,
    CAST(sum("TotBytes") AS bigint) AS total_bytes, avg("Rate") AS avg_rate, avg("Dur") AS avg_duration_seconds
  FROM flows f LEFT JOIN category c ON f.attack_type = c.attack_type GROUP BY ALL)
"""


@query(
    "a1_attack_summary",
    on_flows(A1 + """SELECT attack_type, attack_category, attack_tool, label, flow_count, total_bytes,
      round(avg_rate, 6) AS avg_rate, round(avg_duration_seconds, 6) AS avg_duration_seconds,
      round(100.0::double * flow_count / sum(flow_count) OVER (), 2) AS pct_of_total_flows FROM by_attack"""),
)
def _(t):
    return rounded(marts.attack_summary(t.staging))


@query(
    "w1_share_of_total",
    on_flows("""SELECT attack_type, count(*) AS flow_count,
      round(100.0::double * count(*) / sum(count(*)) OVER (), 2) AS pct FROM flows GROUP BY attack_type"""),
)
def _(t):
    summary = marts.attack_summary(t.staging)
    return rounded(
        summary.groupBy("attack_type").agg(F.sum("flow_count").alias("flow_count")).select(
            "attack_type", "flow_count",
            F.round(F.lit(100.0) * F.col("flow_count") / F.sum("flow_count").over(Window.partitionBy()), 2).alias("pct"),
        )
    )


TRAFFIC = CATEGORY_SQL + """, traffic AS (
  SELECT date_trunc('hour', ingestion_timestamp)::timestamp AS flow_hour, "Label" AS label, f.attack_type, c.attack_category,
    count(*) AS flow_count, CAST(sum("TotBytes") AS bigint) AS total_bytes
  FROM flows f LEFT JOIN category c ON f.attack_type = c.attack_type GROUP BY ALL)
"""


@query("a2_traffic_by_hour", on_flows(TRAFFIC + "SELECT * FROM traffic"))
def _(t):
    return plain_times(marts.traffic_by_hour(t.staging))


@query(
    "a3_protocol_breakdown",
    on_flows("""SELECT "Proto" AS proto, attack_type, count(*) AS flow_count, round(avg("TotPkts"), 6) AS avg_packets,
      round(avg("sMeanPktSz"), 6) AS avg_src_packet_size FROM flows GROUP BY 1, 2"""),
)
def _(t):
    return rounded(marts.protocol_breakdown(t.staging))


QUALITY = LOG_SQL + """, summary AS (
  SELECT date_trunc('hour', event_timestamp)::timestamp AS batch_hour, count(*) AS total_batches,
    count(*) FILTER (success) AS passed_batches, count(*) FILTER (NOT success) AS failed_batches,
    round(100.0::double * count(*) FILTER (success) / count(*), 2) AS pass_rate_pct,
    CAST(sum(row_count) AS bigint) AS total_rows_validated,
    CAST(sum(n_failed_expectations) AS bigint) AS total_failed_expectations
  FROM quality_log GROUP BY 1)
"""


@query("a4_quality_summary", QUALITY + "SELECT * FROM summary")
def _(t):
    return plain_times(marts.quality_summary(marts.staging_quality_log(t.quality_log)))


@query(
    "a19_log_totals",
    LOG_SQL + """SELECT count(*) AS batches, CAST(sum(row_count) AS bigint) AS rows_validated,
      CAST(sum(n_failed_expectations) AS bigint) AS failed_expectations FROM quality_log""",
)
def _(t):
    return t.quality_log.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("row_count").alias("rows_validated"),
        F.sum("n_failed_expectations").alias("failed_expectations"),
    )


@query(
    "p5_staging_projection",
    on_flows("""SELECT event_id, ingestion_timestamp, "Dur" AS dur, "Proto" AS proto, "dTtl" AS dttl, "TotBytes" AS totbytes,
      "Label" AS label, attack_type FROM flows"""),
)
def _(t):
    shown = ("event_id", "ingestion_timestamp", "dur", "proto", "dttl", "totbytes", "label", "attack_type")
    return plain_times(t.staging.select(*shown))


@query(
    "j1_category_left_join",
    on_flows(CATEGORY_SQL + """SELECT f.event_id, f.attack_type, c.attack_category
      FROM flows f LEFT JOIN category c ON f.attack_type = c.attack_type"""),
)
def _(t):
    return marts.with_category(t.flows.select("event_id", "attack_type")).select(
        "event_id", "attack_type", "attack_category"
    )


@query(
    "j2_prediction_flow_join",
    on_flows(SCORED_SQL + """SELECT event_id, predicted_class, round(probability, 6) AS probability,
      ingestion_timestamp AS flow_timestamp FROM scored WHERE predicted_class <> 'Benign'"""),
)
def _(t):
    predictions = t.scored.filter("predicted_class <> 'Benign'").select("event_id", "predicted_class", "probability")
    return rounded(join_predictions(predictions, t.flows))


@query(
    "j3_unscored_flows",
    on_flows(SCORED_SQL + "SELECT event_id, attack_type FROM scored WHERE predicted_class = 'Benign'"),
)
def _(t):
    predictions = t.scored.filter("predicted_class <> 'Benign'")
    return without_prediction(t.flows.select("event_id", "attack_type"), predictions)


@query(
    "j4_label_alignment",
    on_flows("""SELECT f.event_id, f."Dur" AS dur, l."Label" AS label FROM flows f JOIN flows l USING (event_id)"""),
)
def _(t):
    features = t.flows.select("event_id", F.col("Dur").alias("dur"))
    return features.join(t.flows.select("event_id", F.col("Label").alias("label")), "event_id")


@query(
    "s18_mart_over_view",
    on_flows(A1 + "SELECT attack_type, attack_category, CAST(sum(flow_count) AS bigint) AS flow_count FROM by_attack GROUP BY ALL"),
)
def _(t):
    from flowlake.sources.tables import expose

    expose({"stg_flows": t.staging}, {})
    return (
        marts.attack_summary(t.spark.table("stg_flows")).groupBy("attack_type", "attack_category")
        .agg(F.sum("flow_count").alias("flow_count"))
    )
