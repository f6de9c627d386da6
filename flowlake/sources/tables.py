"""Schemas of the stored tables, and creating them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from flowlake import contract
from flowlake.operators.quality import LOG_SCHEMA
from flowlake.operators.score import ALERTS_SCHEMA, PREDICTIONS_SCHEMA


BRONZE = (
    "kafka_key string, raw_json string, topic string, partition int, offset bigint, kafka_timestamp timestamp"
)
PERFORMANCE = (
    "model_version string, class string, precision_score double, recall_score double, f1_score double, "
    "support bigint, accuracy double, macro_f1 double, weighted_f1 double, evaluated_at timestamp"
)
IMPORTANCE = "model_version string, class string, feature string, mean_abs_shap double, feature_rank bigint"
DRIFT = (
    "feature string, psi double, ks_statistic double, ks_p_value double, drifted int, share_drifted double, "
    "dataset_drift_detected int, reference_size bigint, current_size bigint, computed_at timestamp"
)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


TABLES = {
    "bronze_flows": BRONZE,
    "silver_flows": _ddl(contract.silver_schema()) + ", loaded_at timestamp",
    "quality_log": _ddl(LOG_SCHEMA) + ", loaded_at timestamp",
    "gold_model_predictions": _ddl(PREDICTIONS_SCHEMA) + ", loaded_at timestamp",
    "gold_security_alerts": _ddl(ALERTS_SCHEMA) + ", loaded_at timestamp",
    "gold_model_performance": PERFORMANCE,
    "gold_shap_global": IMPORTANCE,
    "gold_drift": DRIFT,
}


def create_tables(spark: SparkSession, fmt: str = "parquet", names: list[str] | None = None) -> None:
    for name in names or TABLES:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({TABLES[name]}) USING {fmt}")


def expose(staging: dict[str, DataFrame], marts: dict[str, DataFrame], fmt: str = "parquet") -> None:
    """Staging as views, marts as stored tables."""
    for name, df in staging.items():
        df.createOrReplaceTempView(name)
    for name, df in marts.items():
        df.write.format(fmt).mode("overwrite").saveAsTable(name)
