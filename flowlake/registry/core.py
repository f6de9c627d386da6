"""Registration, table access and the shapes shared by several queries."""

from __future__ import annotations

from functools import cached_property
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlake.contract import ATTACK_TYPES
from flowlake.registry.event_flows import event_flows, flows_sql
from flowlake.plans.marts import staging_flows
from flowlake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CLASSES = sorted(ATTACK_TYPES)
SPLIT_DAY = "2024-01-15 00:00:00"
_OPEN: dict[tuple, "Tables"] = {}


class Tables:
    """The given tables of one folder, and frames that Spark derives from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, purpose: str) -> str:
        return scratch_path(self.spark, purpose)

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/events.parquet")

    @cached_property
    def flows(self) -> DataFrame:
        """Contract flows with ``row_id`` and ``Seq``; times as session timestamps."""
        return flows_of(self.spark, self.events)

    @cached_property
    def staging(self) -> DataFrame:
        return staging_flows(self.flows)

    @cached_property
    def quality_log(self) -> DataFrame:
        grouped = self.events.groupBy(F.floor(F.col("event_id") / 5.0).cast("bigint").alias("batch_id")).agg(
            F.min("ts").cast("timestamp").alias("event_timestamp"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col("value") > 150).alias("n_failed_expectations"),
        )
        return grouped.withColumns(
            {"success": F.col("n_failed_expectations") == 0, "failed_expectation_summary": F.lit(None).cast("string")}
        )

    @cached_property
    def scored(self) -> DataFrame:
        return add_rule_score(self.flows)

    @cached_property
    def reference(self) -> DataFrame:
        return self.flows.filter(F.col("ingestion_timestamp") < F.to_timestamp(F.lit(SPLIT_DAY)))

    @cached_property
    def current(self) -> DataFrame:
        return self.flows.filter(F.col("ingestion_timestamp") >= F.to_timestamp(F.lit(SPLIT_DAY)))

    def kept(self, name: str, make: Callable[[], object]):
        """A fitted model that several queries of a session use."""
        store = self.__dict__.setdefault("_kept", {})
        if name not in store:
            store[name] = make()
        return store[name]


def flows_of(spark: SparkSession, events: DataFrame) -> DataFrame:
    return event_flows(spark, events).withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp"))


def add_rule_score(flows: DataFrame) -> DataFrame:
    """A fixed rule in place of a model, so that results can be checked in SQL."""
    k = F.col("TotPkts") - 1
    confused = (F.col("attack_type") == "Benign") & (k % 5 < 3)
    return flows.withColumns(
        {
            "predicted_class": F.when(confused, "UDPFlood").otherwise(F.col("attack_type")),
            "probability": F.lit(0.55) + (k % 45) / F.lit(100.0),
            "model_version": F.lit("rule-1"),
        }
    )


SCORED_SQL = """, scored AS (
  SELECT *, CASE WHEN attack_type = 'Benign' AND ("TotPkts" - 1) % 5 < 3 THEN 'UDPFlood' ELSE attack_type END AS predicted_class,
    CAST(0.55 AS double) + (("TotPkts" - 1) % 45) / CAST(100 AS double) AS probability,
    'rule-1' AS model_version
  FROM flows)
"""

ALERTS_SQL = SCORED_SQL + """, alerts AS (
  SELECT event_id, predicted_class, probability, model_version, ingestion_timestamp AS flow_timestamp,
    CASE WHEN probability >= 0.9::double THEN 'High' WHEN probability >= 0.7::double THEN 'Medium' ELSE 'Low' END AS severity
  FROM scored WHERE predicted_class <> 'Benign')
"""

CATEGORY_SQL = """, category AS (
  SELECT * FROM (VALUES ('Benign', 'Benign'), ('UDPFlood', 'DoS'), ('HTTPFlood', 'DoS'), ('SlowrateDoS', 'DoS'),
    ('SYNFlood', 'DoS'), ('ICMPFlood', 'DoS'), ('TCPConnectScan', 'Reconnaissance'), ('SYNScan', 'Reconnaissance'),
    ('UDPScan', 'Reconnaissance')) AS c(attack_type, attack_category))
"""

LOG_SQL = """WITH quality_log AS (
  SELECT CAST(floor(event_id / 5.0) AS bigint) AS batch_id, min(ts) AS event_timestamp, count(*) AS row_count,
    count(*) FILTER (value > 150) AS n_failed_expectations, count(*) FILTER (value > 150) = 0 AS success
  FROM events GROUP BY 1)
"""


def on_flows(text: str) -> str:
    """SQL that starts from the flows; ``text`` may open with further table expressions."""
    return f"WITH {flows_sql()} {text}"


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            key = (spark.sparkContext.applicationId, folder)
            if key not in _OPEN:
                _OPEN[key] = Tables(spark, folder)
            return function(_OPEN[key])

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = settled(oracle)
        return function

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def nudge(digits: int) -> float:
    """A small step before rounding, so that exact ties do not depend on the order of additions."""
    return 3.7 * 10.0 ** -(digits + 4)


def settled(sql: str) -> str:
    """The same step in every ``round(x, digits)`` of more than two digits in a SQL text."""
    out, start = [], 0
    while (found := sql.find("round(", start)) >= 0:
        depth, comma, end = 1, None, found + len("round(")
        while depth:
            char = sql[end]
            depth += (char == "(") - (char == ")")
            if char == "," and depth == 1:
                comma = end
            end += 1
        inner, digits = sql[found + len("round("):comma], int(sql[comma + 1:end - 1])
        step = f" + {nudge(digits)!r}::double" if digits > 2 else ""
        out.append(f"{sql[start:found]}round(({settled(inner)}){step}, {digits})")
        start = end
    return "".join(out) + sql[start:]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show; times without a zone."""
    shown = plain_times(df)
    return shown.select(
        [
            F.round(F.col(f"`{f.name}`") + nudge(digits), digits).alias(f.name)
            if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
            for f in shown.schema
        ]
    )
