"""Scoring in the cluster: predictions, alerts and their stored form."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowlake.functions.scalar import quoted, severity
from flowlake.operators.train import Classifier

PREDICTIONS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("predicted_class", T.StringType()),
        T.StructField("probability", T.FloatType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("prediction_timestamp", T.TimestampType()),
        T.StructField("flow_timestamp", T.TimestampType()),
    ]
)
ALERTS_SCHEMA = T.StructType(
    PREDICTIONS_SCHEMA.fields[:4] + [T.StructField("severity", T.StringType())] + PREDICTIONS_SCHEMA.fields[4:]
)


def best_class(probabilities: str, classes: list[str]) -> tuple[Column, Column]:
    """Most probable class, the first one on a tie, and its probability."""
    top = F.array_max(probabilities)
    names = F.array(*[F.lit(c) for c in classes])
    return F.get(names, (F.array_position(probabilities, top) - 1).cast("int")), top


def score_matrix(matrix: DataFrame, classifier: Classifier) -> DataFrame:
    """Add class, probability, all probabilities and versions to a model matrix."""
    scored = classifier.with_probabilities(matrix)
    predicted, top = best_class("probabilities", classifier.classes)
    names = F.array(*[F.lit(c) for c in classifier.classes])
    return scored.withColumns(
        {
            "predicted_class": predicted,
            "probability": top,
            "all_probabilities": F.map_from_arrays(names, F.col("probabilities")),
            "model_version": F.lit(classifier.version),
            "schema_version": F.lit(classifier.schema_version),
        }
    )


def score_flows(flows: DataFrame, classifier: Classifier, keep: list[str] | None = None) -> DataFrame:
    """Score raw contract flows; the row keeps its id, time and the ``keep`` columns."""
    carried = [c for c in ("event_id", "ingestion_timestamp", *(keep or [])) if c in flows.columns]
    matrix = classifier.encoder.transform(flows, carried)
    scored = score_matrix(matrix, classifier)
    return scored.select(
        *[quoted(c) for c in carried],
        "predicted_class", "probability", "all_probabilities", "model_version", "schema_version",
    )


def score_with(
    flows: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Score with any pandas function: a batch of rows in, a batch of predictions out.

    Batches are Arrow record batches of the session's configured size; a failed
    task is retried by Spark.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield scorer(batch)

    return flows.mapInPandas(run, schema)


def as_predictions(scored: DataFrame, now: Column | None = None) -> DataFrame:
    """Predictions with both clocks: when the flow happened and when it was scored.

    The probability is still a double, so that alert grades are taken before it
    is stored in 32 bits.
    """
    now = F.current_timestamp() if now is None else now
    flow_time = F.col("ingestion_timestamp") if "ingestion_timestamp" in scored.columns else F.lit(None)
    return scored.select(
        "event_id", "predicted_class", "probability", "model_version",
        now.cast("timestamp").alias("prediction_timestamp"),
        F.coalesce(flow_time.cast("timestamp"), now.cast("timestamp")).alias("flow_timestamp"),
    )


def as_alerts(predictions: DataFrame) -> DataFrame:
    """Malicious predictions only, with a severity."""
    return (
        predictions.filter(F.col("predicted_class") != "Benign")
        .withColumn("severity", severity(F.col("probability").cast("double")))
        .select(*ALERTS_SCHEMA.fieldNames())
    )


def stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the stored types, in stored order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
