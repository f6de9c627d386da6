"""Distributed training on the model matrix."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any, Callable

from pyspark import StorageLevel
from pyspark.ml import functions as MF
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlake.contract import SCHEMA_VERSION
from flowlake.functions.scalar import quoted
from flowlake.operators import boosting, forest, logistic
from flowlake.operators.features import FlowEncoder
from flowlake.operators.lookup import lookup_join
from flowlake.operators.sampling import balanced_weights

# Hand-set class weights and boosting settings.
MANUAL_WEIGHTS = {
    "Benign": 1.5,
    "UDPFlood": 0.7,
    "HTTPFlood": 1.0,
    "ICMPFlood": 10.0,
    "SYNFlood": 3.0,
    "SYNScan": 3.0,
    "SlowrateDoS": 1.0,
    "TCPConnectScan": 3.0,
    "UDPScan": 3.0,
}
BOOSTING = {"rounds": 200, "depth": 6, "rate": 0.1}
FINGERPRINT_COLUMN = "sMeanPktSz"
SEED = 42

LOADERS = {
    "logistic": logistic.LogisticModel.load,
    "forest": forest.ForestModel.load,
    "boosted": boosting.BoostedModel.load,
    "boosted_binary": boosting.BoostedModel.load,
}


@dataclass(frozen=True)
class Classifier:
    """A fitted model with its input columns, class names and version."""

    kind: str
    model: Any
    features: list[str]
    classes: list[str]
    version: str = "1"
    scaler: Any = None
    encoder: FlowEncoder | None = None
    schema_version: str = SCHEMA_VERSION

    def with_probabilities(self, matrix: DataFrame, out: str = "probabilities") -> DataFrame:
        """Add one probability per class as an array, in the order of ``classes``."""
        before = matrix.columns
        scored = self.model.transform(self._vectors(matrix))
        return scored.withColumn(out, MF.vector_to_array("probability")).select(*[quoted(c) for c in before], out)

    def _vectors(self, matrix: DataFrame) -> DataFrame:
        vectors = matrix.withColumn("features", feature_vector(self.features))
        return scale(self.scaler, vectors)

    def save(self, spark: SparkSession, path: str) -> None:
        if isinstance(self.model, LogisticRegressionModel):
            self.model.write().overwrite().save(f"{path}/model")
        else:
            self.model.save(spark, f"{path}/model")
        if self.scaler is not None:
            self.scaler.write().overwrite().save(f"{path}/scaler")
        about = {
            "kind": self.kind, "features": self.features, "classes": self.classes,
            "version": self.version, "scaled": self.scaler is not None,
            "encoder": self.encoder.to_json() if self.encoder else None,
            "schema_version": self.schema_version,
            "by_spark": isinstance(self.model, LogisticRegressionModel),
        }
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Classifier":
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        # Logistic models were once fitted and stored by Spark.
        if about["kind"] == "logistic" and about.get("by_spark", True):
            model = LogisticRegressionModel.load(f"{path}/model")
        else:
            model = LOADERS[about["kind"]](spark, f"{path}/model")
        return cls(
            about["kind"],
            model,
            about["features"],
            about["classes"],
            about["version"],
            StandardScalerModel.load(f"{path}/scaler") if about["scaled"] else None,
            FlowEncoder.from_json(about["encoder"]) if about["encoder"] else None,
            about["schema_version"],
        )


def feature_vector(features: list[str]) -> Column:
    return MF.array_to_vector(F.array(*[quoted(c).cast("double") for c in features]))


def scale(scaler: StandardScalerModel | None, vectors: DataFrame) -> DataFrame:
    if scaler is None:
        return vectors
    return scaler.transform(vectors).drop("features").withColumnRenamed("scaled", "features")


def label_classes(df: DataFrame, label: str) -> list[str]:
    """Class names in alphabetical order; their positions are the encoded labels."""
    model = StringIndexer(inputCol=label, outputCol="__i", stringOrderType="alphabetAsc").fit(df)
    return list(model.labels)


def encode_label(df: DataFrame, label: str, classes: list[str], out: str = "label_index") -> DataFrame:
    """Label to its position; labels that training has not seen become null."""
    names = F.array(*[F.lit(c) for c in classes])
    position = F.array_position(names, quoted(label)).cast("double") - 1
    return df.withColumn(out, F.when(position >= 0, position))


def decode_label(index: Column, classes: list[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), index.cast("int"))


def with_balanced_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = balanced_weights(df, label).select(label, F.col("weight").alias(out))
    return lookup_join(df, weights, [label])


def with_manual_weight(
    df: DataFrame, label: str, weights: dict[str, float] | None = None, out: str = "weight"
) -> DataFrame:
    """Weight by class name from a fixed list; a class that is not listed is an error at run time."""
    pairs = [F.lit(x) for item in (weights or MANUAL_WEIGHTS).items() for x in item]
    weight = F.create_map(*pairs)[quoted(label)]
    unknown = F.raise_error(F.concat(F.lit("no weight for class "), F.coalesce(quoted(label), F.lit("null"))))
    return df.withColumn(out, F.coalesce(weight, unknown.cast("double")))


def _fit(
    kind: str,
    train: DataFrame,
    features: list[str],
    label: str,
    make: Callable[..., Any],
    weight: str | None,
    scaled: bool = False,
    classes: list[str] | None = None,
    version: str = "1",
    encoder: FlowEncoder | None = None,
) -> Classifier:
    classes = classes or label_classes(train, label)
    kept = [weight] if weight else []
    vectors = encode_label(train, label, classes).select(
        "label_index", *kept, feature_vector(features).alias("features")
    )
    if scaled:
        # The rows are stored once and standardised where they are read.
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(vectors)
        return Classifier(kind, make(vectors, scaler), features, classes, version, scaler, encoder)
    # Training reads its input many times.
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = make(vectors, len(classes))
    finally:
        vectors.unpersist()
    return Classifier(kind, model, features, classes, version, None, encoder)


def fit_logistic(
    train: DataFrame, features: list[str], label: str, weight: str | None = "weight",
    strength: float = 1.0, iterations: int = 1000, tolerance: float = 1e-4, **kw,
) -> Classifier:
    """Multinomial logistic regression on standardised columns.

    ``strength`` divides the penalty of a summed loss. Training stops at
    ``tolerance`` or after ``iterations``.
    """

    def make(vectors: DataFrame, scaler: StandardScalerModel):
        means, spread = scaler.mean.toArray(), scaler.std.toArray()
        return logistic.fit(vectors, "features", "label_index", weight, means, spread, strength, iterations, tolerance)

    return _fit("logistic", train, features, label, make, weight, scaled=True, **kw)


def fit_forest(
    train: DataFrame, features: list[str], label: str, weight: str | None = "weight",
    trees: int = 100, depth: int = 20, bins: int = 64, **kw,
) -> Classifier:
    """Random forest of deep trees."""

    def make(vectors: DataFrame, k: int):
        return forest.fit(vectors, "features", "label_index", k, weight, trees, depth, bins, SEED)

    return _fit("forest", train, features, label, make, weight, **kw)


def fit_boosted(
    train: DataFrame, features: list[str], label: str, weight: str | None = "weight",
    rounds: int = BOOSTING["rounds"], depth: int = BOOSTING["depth"], rate: float = BOOSTING["rate"], **kw,
) -> Classifier:
    """Gradient-boosted trees for several classes: one model, softmax loss, a tree per class and round."""

    def make(vectors: DataFrame, k: int):
        return boosting.fit(vectors, "features", "label_index", max(k, 3), weight, rounds, depth, rate)

    return _fit("boosted", train, features, label, make, weight, **kw)


def fit_boosted_binary(
    train: DataFrame, features: list[str], label: str, positive: Column, names: tuple[str, str],
    weight: str | None = None, rounds: int = BOOSTING["rounds"], depth: int = BOOSTING["depth"],
    rate: float = BOOSTING["rate"], **kw,
) -> Classifier:
    """Boosted trees for a yes/no target; ``names`` are the negative and positive class."""

    def make(vectors: DataFrame, k: int):
        return boosting.fit(vectors, "features", "label_index", 2, weight, rounds, depth, rate)

    two = train.withColumn("__side", F.when(positive, names[1]).otherwise(names[0]))
    return _fit("boosted_binary", two, features, "__side", make, weight, classes=list(names), **kw)


def fit_malicious(train: DataFrame, features: list[str], label: str = "attack_type", **kw) -> Classifier:
    """Is a flow malicious at all? Without class weights."""
    return fit_boosted_binary(train, features, label, F.col(label) != "Benign", ("Benign", "Malicious"), **kw)


def fit_specialist(
    train: DataFrame, features: list[str], label: str = "attack_type",
    pair: tuple[str, str] = ("Benign", "UDPFlood"), **kw,
) -> Classifier:
    """Two-class probe on the confused pair only, balanced and without the fingerprint column."""
    subset = class_subset(train, label, pair)
    weighted = with_balanced_weight(subset, label)
    columns = without_fingerprint(features)
    return fit_boosted_binary(weighted, columns, label, F.col(label) == pair[1], pair, weight="weight", **kw)


def class_subset(df: DataFrame, label: str, classes: tuple[str, ...]) -> DataFrame:
    return df.filter(F.col(label).isin(*classes))


def without_fingerprint(features: list[str]) -> list[str]:
    return [c for c in features if c != FINGERPRINT_COLUMN]


def feature_importance(classifier: Classifier, spark: SparkSession, top: int | None = None) -> DataFrame:
    """Importance per feature, largest first: mean |coefficient| or gain."""
    model = classifier.model
    if classifier.kind == "logistic":
        values = abs(model.coefficientMatrix.toArray()).mean(axis=0)
    else:
        # A forest has no entries behind its last feature with a split.
        values = [*model.importances, *[0.0] * (len(classifier.features) - len(model.importances))]
    rows = [(name, float(value)) for name, value in zip(classifier.features, values)]
    table = spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return table.limit(top) if top else table
