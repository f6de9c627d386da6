"""Why a model decides: additive contributions per row, and their averages.

Linear models are explained with column expressions. Tree ensembles go to the tasks as
flat node arrays, whose size is linear in the nodes, and each Arrow batch is walked through them.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from flowlake.functions.scalar import quoted
from flowlake.operators.train import Classifier
from flowlake.operators.trees import FlatTrees, contributions, own_contributions

#: Rows that are explained together.
ROWS = 2048

IMPORTANCE_SCHEMA = (
    "model_version string, class string, feature string, mean_abs_shap double, feature_rank bigint"
)


# ---- linear models -----------------------------------------------------------


def linear_contributions(matrix: DataFrame, classifier: Classifier, out: str = "contributions") -> DataFrame:
    """Add an array per class: coefficient times distance from the training mean."""
    weights = classifier.model.coefficientMatrix.toArray()
    spread = np.asarray(classifier.scaler.std.toArray(), dtype=float)
    means = np.asarray(classifier.scaler.mean.toArray(), dtype=float)
    per_unit = np.divide(weights, spread, out=np.zeros_like(weights), where=spread > 0)
    row = F.array(*[quoted(c).cast("double") for c in classifier.features])
    centred = F.zip_with(row, F.lit([float(v) for v in means]), lambda x, m: x - m)
    classes = [
        F.zip_with(centred, F.lit([float(v) for v in line]), lambda x, w: x * w) for line in per_unit
    ]
    return matrix.withColumn(out, F.array(*classes))


# ---- trees -------------------------------------------------------------------


def model_trees(spark: SparkSession, classifier: Classifier) -> FlatTrees:
    """The trees of a fitted model, scaled so that their answers add up to its output."""
    if hasattr(classifier.model, "trees") and isinstance(classifier.model.trees, FlatTrees):
        return classifier.model.trees
    raise ValueError("this model type has no readable trees")


def _row(features: list[str]) -> Column:
    return F.array(*[quoted(c).cast("double") for c in features]).alias("__row")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The rows of a batch as one matrix."""
    rows = batch.column(batch.schema.get_field_index("__row"))
    return rows.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)


def forest_contributions(
    matrix: DataFrame, classifier: Classifier, keep: list[str], out: str = "contributions"
) -> DataFrame:
    """The ``keep`` columns, the row's feature values and one contribution array per class."""
    spark = matrix.sparkSession
    sent = spark.sparkContext.broadcast(model_trees(spark, classifier))
    rows = matrix.select(*[quoted(c) for c in keep], _row(classifier.features))
    numbers = T.ArrayType(T.ArrayType(T.DoubleType()))
    schema = T.StructType([*rows.schema.fields, T.StructField(out, numbers)])

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = contributions(_matrix(part), sent.value)
                n, outputs, width = found.shape
                inner = pa.ListArray.from_arrays(np.arange(0, n * outputs * width + 1, width, dtype=np.int32) if width else np.zeros(n * outputs + 1, np.int32), found.ravel())
                lists = pa.ListArray.from_arrays(np.arange(0, n * outputs + 1, outputs, dtype=np.int32), inner)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=schema.names)

    return rows.mapInArrow(explain, schema)


# ---- tables ------------------------------------------------------------------


def _ranked(table: DataFrame, version: str) -> DataFrame:
    order = Window.partitionBy("class").orderBy(F.desc("mean_abs_shap"), "feature")
    return table.select(
        F.lit(version).alias("model_version"), "class", "feature", "mean_abs_shap",
        F.row_number().over(order).cast("bigint").alias("feature_rank"),
    )


def importance_table(means: DataFrame, version: str) -> DataFrame:
    """Ranked importance per class plus 'Overall', the mean over classes, from (class, feature, mean)."""
    overall = means.groupBy("feature").agg(F.avg("mean_abs_shap").alias("mean_abs_shap"))
    both = means.select("class", "feature", "mean_abs_shap").unionByName(
        overall.select(F.lit("Overall").alias("class"), "feature", "mean_abs_shap")
    )
    return _ranked(both, version)


def global_importance(matrix: DataFrame, classifier: Classifier) -> DataFrame:
    """Ranked mean |contribution| per class and overall.

    For forests a task adds up its own rows, so only one sum per class and
    feature leaves it.
    """
    if classifier.kind == "logistic":
        means = _linear_means(matrix, classifier)
        return importance_table(means, classifier.version)
    spark = matrix.sparkSession
    sent = spark.sparkContext.broadcast(model_trees(spark, classifier))
    classes = classifier.classes[1:] if classifier.kind == "boosted_binary" else classifier.classes
    features = classifier.features

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros((len(classes), len(features))), 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                found = contributions(_matrix(batch.slice(start, ROWS)), sent.value)
                sums += np.abs(found).sum(axis=0)
                count += len(found)
        if count:
            yield pa.RecordBatch.from_pydict(
                {
                    "class": np.repeat(classes, len(features)),
                    "feature": np.tile(features, len(classes)),
                    "total": sums.ravel(),
                    "n": np.full(sums.size, count),
                }
            )

    parts = matrix.select(_row(features)).mapInArrow(totals, "class string, feature string, total double, n bigint")
    means = parts.groupBy("class", "feature").agg((F.sum("total") / F.sum("n")).alias("mean_abs_shap"))
    return importance_table(means, classifier.version)


def _linear_means(matrix: DataFrame, classifier: Classifier) -> DataFrame:
    """For a linear model the mean is |weight| times the mean distance from the training mean."""
    means = [float(v) for v in classifier.scaler.mean.toArray()]
    spread = np.asarray(classifier.scaler.std.toArray(), dtype=float)
    weights = classifier.model.coefficientMatrix.toArray()
    per_unit = np.abs(np.divide(weights, spread, out=np.zeros_like(weights), where=spread > 0))
    distances = matrix.agg(
        *[F.avg(F.abs(quoted(c).cast("double") - F.lit(means[i]))).alias(f"d{i}") for i, c in enumerate(classifier.features)]
    )
    by_feature = distances.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("feature"), F.col(f"d{i}").alias("distance"),
                        F.lit([float(v) for v in per_unit[:, i]]).alias("units"),
                    )
                    for i, name in enumerate(classifier.features)
                ]
            )
        )
    )
    names = F.array(*[F.lit(c) for c in classifier.classes])
    return by_feature.select("feature", "distance", F.posexplode("units").alias("i", "unit")).select(
        F.get(names, F.col("i")).alias("class"), "feature", (F.col("distance") * F.col("unit")).alias("mean_abs_shap")
    )


def top_features(row: Column, contributions: Column, features: list[str], k: int = 5) -> Column:
    """The k features with the largest absolute contribution, as an array of structs."""
    names = F.array(*[F.lit(f) for f in features])
    items = F.transform(
        F.arrays_zip(names.alias("f"), row.alias("v"), contributions.alias("c")),
        lambda x: F.struct(
            (-F.abs(x["c"])).alias("order"), x["f"].alias("feature"), x["v"].alias("value"), x["c"].alias("contribution")
        ),
    )
    best = F.slice(F.array_sort(items), 1, k)
    return F.transform(
        best,
        lambda x: F.struct(
            x["feature"].alias("feature"), x["value"].alias("value"), x["contribution"].alias("shap_contribution")
        ),
    )


def explain_rows(scored: DataFrame, classifier: Classifier, keep: list[str], k: int = 5) -> DataFrame:
    """Class, probability and the top features of each scored matrix row, for its own class.

    ``scored`` is a matrix with ``predicted_class`` and ``probability``. For trees only the row's
    own class is worked out, and only the k features leave the task.
    """
    columns = [*keep, "predicted_class", "probability"]
    if classifier.kind != "logistic":
        return _explained_by_trees(scored, classifier, columns, k)
    names = F.array(*[F.lit(c) for c in classifier.classes])
    contributed = linear_contributions(scored, classifier).withColumn("__row", _row(classifier.features))
    own = F.get("contributions", (F.array_position(names, F.col("predicted_class")) - 1).cast("int"))
    return contributed.select(
        *[quoted(c) for c in columns], top_features(F.col("__row"), own, classifier.features, k).alias("top_features")
    )


def _explained_by_trees(scored: DataFrame, classifier: Classifier, columns: list[str], k: int) -> DataFrame:
    spark = scored.sparkSession
    sent = spark.sparkContext.broadcast(model_trees(spark, classifier))
    classes, features, binary = classifier.classes, classifier.features, classifier.kind == "boosted_binary"
    rows = scored.select(*[quoted(c) for c in columns], _row(features))
    kind = T.ArrayType(T.StructType([T.StructField("feature", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("shap_contribution", T.DoubleType())]))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("top_features", kind)])
    # Equal sizes go by name.
    names = np.array(features, dtype=object)
    by_name = np.argsort(names)
    k = min(k, len(features))

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                values, place = _matrix(part), len(columns) - 2
                own = np.array([classes.index(c) for c in part.column(place).to_pylist()], np.int64)
                found = own_contributions(values, sent.value, np.zeros_like(own) if binary else own)
                if binary:
                    found = found * np.where(own == 1, 1.0, -1.0)[:, None]
                best = by_name[np.argsort(-np.abs(found[:, by_name]), axis=1, kind="stable")[:, :k]]
                pick = lambda table: np.take_along_axis(table, best, axis=1).ravel()
                items = pa.StructArray.from_arrays([pa.array(names[best].ravel(), pa.string()), pa.array(pick(values)), pa.array(pick(found))], ["feature", "value", "shap_contribution"])
                lists = pa.ListArray.from_arrays(np.arange(0, len(best) * k + 1, k, dtype=np.int32), items)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=schema.names)

    return rows.mapInArrow(explain, schema)
