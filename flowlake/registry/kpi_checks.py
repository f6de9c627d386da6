"""Dashboard queries."""

from pyspark.sql import functions as F

from flowlake.contract import ATTACK_TYPES
from flowlake.operators.score import as_alerts, as_predictions
from flowlake.plans import kpi, marts
from flowlake.registry.core import ALERTS_SQL, SCORED_SQL, on_flows, plain_times, query, rounded
from flowlake.registry.mart_checks import A1, QUALITY, TRAFFIC


def _traffic(t):
    return marts.traffic_by_hour(t.staging)


def _alerts(t):
    return as_alerts(as_predictions(t.scored))


B1 = TRAFFIC + ALERTS_SQL + """
SELECT 'total_flows' AS metric, CAST(sum(flow_count) AS double) AS value FROM traffic
UNION ALL SELECT 'malicious_rate_pct', round(100.0::double * sum(flow_count) FILTER (label = 'Malicious') / sum(flow_count), 2) FROM traffic
UNION ALL SELECT 'flows_last_24h', CAST(sum(flow_count) AS double) FROM traffic
  WHERE flow_hour >= (SELECT max(flow_hour) FROM traffic) - INTERVAL 24 HOUR
UNION ALL SELECT 'total_alerts', CAST(count(*) AS double) FROM alerts
UNION ALL SELECT 'high_severity_alerts', CAST(count(*) FILTER (severity = 'High') AS double) FROM alerts
"""


@query("b1_overview_cards", on_flows(B1))
def _(t):
    return kpi.overview(_traffic(t), _alerts(t))


@query(
    "b2_flows_over_time",
    on_flows(TRAFFIC + """SELECT flow_hour,
      CAST(coalesce(sum(flow_count) FILTER (label = 'Benign'), 0) AS bigint) AS benign_flows,
      CAST(coalesce(sum(flow_count) FILTER (label = 'Malicious'), 0) AS bigint) AS malicious_flows,
      round(100.0::double * coalesce(sum(flow_count) FILTER (label = 'Malicious'), 0) / sum(flow_count), 2) AS malicious_rate_pct
      FROM traffic GROUP BY 1"""),
)
def _(t):
    return plain_times(kpi.flows_over_time(_traffic(t)))


def _mix(by: str, where: str = "") -> str:
    return on_flows(TRAFFIC + f"""SELECT {by}, CAST(sum(flow_count) AS bigint) AS flow_count,
      round(100.0::double * sum(flow_count) / sum(sum(flow_count)) OVER (), 2) AS pct FROM traffic {where} GROUP BY 1""")


@query("b3_attack_mix", _mix("attack_type"))
def _(t):
    return kpi.attack_mix(_traffic(t))


@query("b3_family_mix", _mix("attack_category"))
def _(t):
    return kpi.attack_mix(_traffic(t), "attack_category")


@query(
    "b3_attack_mix_last_hour",
    _mix("attack_type", "WHERE flow_hour >= (SELECT max(flow_hour) FROM traffic) - INTERVAL 1 HOUR"),
)
def _(t):
    return kpi.attack_mix(_traffic(t), interval="1 HOUR")


LATEST = ALERTS_SQL + """SELECT event_id, predicted_class, round(probability, 6) AS probability, severity, flow_timestamp
  FROM alerts WHERE severity = 'High' ORDER BY flow_timestamp DESC, event_id DESC LIMIT 10"""


@query("b4_latest_critical_alerts", on_flows(LATEST))
def _(t):
    shown = kpi.latest_critical(_alerts(t))
    return rounded(shown.select("event_id", "predicted_class", "probability", "severity", "flow_timestamp"))


ATTACKS = [a for a in ATTACK_TYPES if a != "Benign"]


def _pivot(key: str, values: list[str], column: str, source: str, where: str = "") -> str:
    cols = ", ".join(
        f"""CAST(coalesce(sum(flow_count) FILTER ({column} = '{v}'), 0) AS bigint) AS "{v}" """ for v in values
    )
    return f"SELECT {key}, {cols} FROM {source} {where} GROUP BY 1"


@query(
    "b5_attacks_over_time",
    on_flows(TRAFFIC + _pivot("flow_hour", ATTACKS, "attack_type", "traffic", "WHERE attack_type <> 'Benign'")),
)
def _(t):
    return plain_times(kpi.attacks_over_time(_traffic(t)))


@query(
    "b5_families_over_time",
    on_flows(TRAFFIC + _pivot("flow_hour", ["DoS", "Reconnaissance"], "attack_category", "traffic",
                              "WHERE attack_category IN ('DoS', 'Reconnaissance')")),
)
def _(t):
    return plain_times(kpi.families_over_time(_traffic(t)))


@query(
    "b6_attacks_by_tool",
    on_flows("""SELECT attack_tool, count(*) AS flow_count, CAST(sum("TotBytes") AS bigint) AS total_bytes
      FROM flows WHERE "Label" = 'Malicious' GROUP BY 1"""),
)
def _(t):
    return kpi.attacks_by_tool(marts.attack_summary(t.staging))


@query(
    "b6_attack_profile",
    on_flows("""SELECT attack_type, count(*) AS flow_count, CAST(sum("TotBytes") AS bigint) AS total_bytes,
      round(avg("Rate"), 6) AS avg_rate, round(avg("Dur"), 6) AS avg_duration_seconds,
      count(DISTINCT attack_tool) AS tools FROM flows GROUP BY 1"""),
)
def _(t):
    return rounded(kpi.attack_profile(marts.attack_summary(t.staging)))


PROTO = """, breakdown AS (SELECT "Proto" AS proto, attack_type, count(*) AS flow_count FROM flows GROUP BY 1, 2)
"""


@query("b7_protocol_heatmap", on_flows(PROTO + _pivot("proto", list(ATTACK_TYPES), "attack_type", "breakdown")))
def _(t):
    return kpi.protocol_heatmap(marts.protocol_breakdown(t.staging))


@query(
    "b7_protocol_by_hour",
    on_flows("""SELECT date_trunc('hour', ingestion_timestamp)::timestamp AS flow_hour, "Proto" AS proto, count(*) AS flow_count
      FROM flows GROUP BY 1, 2"""),
)
def _(t):
    return plain_times(kpi.protocol_by_hour(t.staging))


@query(
    "b11_quality_totals",
    QUALITY + """SELECT CAST(sum(total_batches) AS bigint) AS total_batches, CAST(sum(passed_batches) AS bigint) AS passed_batches,
      round(100.0::double * sum(passed_batches) / sum(total_batches), 2) AS pass_rate_pct,
      CAST(sum(total_rows_validated) AS bigint) AS total_rows_validated,
      CAST(sum(total_failed_expectations) AS bigint) AS total_failed_expectations FROM summary""",
)
def _(t):
    return kpi.quality_totals(marts.quality_summary(t.quality_log))


@query(
    "b12_flagged_rates",
    on_flows(SCORED_SQL + """SELECT round(avg(CASE WHEN attack_type <> 'Benign' THEN 1 ELSE 0 END), 6) AS true_rate,
      round(avg(CASE WHEN predicted_class <> 'Benign' THEN 1 ELSE 0 END), 6) AS flagged_rate FROM scored"""),
)
def _(t):
    return rounded(kpi.flagged_rates(t.scored))


@query(
    "f5_last_day",
    on_flows("""SELECT event_id, ingestion_timestamp FROM flows
      WHERE ingestion_timestamp >= (SELECT max(ingestion_timestamp) FROM flows) - INTERVAL 24 HOUR"""),
)
def _(t):
    return plain_times(kpi.since_latest(t.flows.select("event_id", "ingestion_timestamp"), "ingestion_timestamp", "24 HOURS"))


@query(
    "f1_malicious_predictions",
    on_flows(ALERTS_SQL + "SELECT predicted_class, count(*) AS n FROM alerts GROUP BY 1"),
)
def _(t):
    return _alerts(t).groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t7_alert_severity",
    on_flows(ALERTS_SQL + "SELECT event_id, severity, round(probability, 6) AS probability FROM alerts"),
)
def _(t):
    return rounded(_alerts(t).select("event_id", "severity", "probability"))


