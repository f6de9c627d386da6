import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from flowlake.operators import logistic, score, train

NAMES = ["x1", "x2", "x3", "same"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 3)) * [1.0, 50.0, 0.01] + [0.0, 1e5, 3.0]
    y = np.where(x[:, 0] + rng.normal(size=900) > 0.9, "c", np.where(x[:, 1] > 1e5 + 20 * rng.normal(size=900), "b", "a"))
    rows = [(str(i), *map(float, r), 7.5, str(k), 0.5 + i % 3) for i, (r, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "event_id string, x1 double, x2 double, x3 double, same double, y string, weight double").cache()


def spark_fit(data):
    """The fit of Spark's own estimator, as it was used here before."""
    vectors = train.encode_label(data, "y", ["a", "b", "c"]).withColumn("features", train.feature_vector(NAMES))
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(vectors)
    total = data.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        featuresCol="features", labelCol="label_index", weightCol="weight", family="multinomial", maxIter=1000, tol=1e-4,
        regParam=1.0 / total, standardization=False,
    ).fit(train.scale(scaler, vectors))


def test_stops_where_spark_stops(data):
    """Each loss on the way, the coefficients and the probabilities are those of Spark's estimator."""
    old, new = spark_fit(data), train.fit_logistic(data, NAMES, "y")
    assert isinstance(new.model, logistic.LogisticModel)
    assert np.allclose(new.model.losses, old.summary.objectiveHistory, rtol=0, atol=1e-9)
    assert np.allclose(new.model.coefficients, old.coefficientMatrix.toArray(), rtol=0, atol=1e-7)
    assert np.allclose(new.model.intercepts, old.interceptVector.toArray(), rtol=0, atol=1e-7)
    before = train.Classifier("logistic", old, NAMES, new.classes, scaler=new.scaler)
    both = score.score_matrix(data, new).select("event_id", F.col("probabilities").alias("p")).join(
        score.score_matrix(data, before).select("event_id", F.col("probabilities").alias("q")), "event_id"
    ).collect()
    assert len(both) == 900 and np.allclose([r["p"] for r in both], [r["q"] for r in both], rtol=0, atol=1e-7)


def test_rows_of_one_part_are_dealt_over_the_cores(spark, data, monkeypatch):
    monkeypatch.setattr(logistic, "BLOCK_CELLS", 40)
    vectors = train.encode_label(data.coalesce(1), "y", ["a", "b", "c"]).withColumn("features", train.feature_vector(NAMES))
    blocks = logistic.store_blocks(vectors, "features", "label_index", "weight", 4)
    by_part = blocks.groupBy(F.spark_partition_id()).agg(F.sum("rows").alias("n")).collect()
    assert len(by_part) == spark.sparkContext.defaultParallelism and sum(r["n"] for r in by_part) == 900
    assert max(r["n"] for r in by_part) <= 2 * min(r["n"] for r in by_part)
    monkeypatch.setattr(logistic, "BLOCKS_PER_TASK", 5)
    assert logistic.store_blocks(vectors, "features", "label_index", "weight", 4).rdd.getNumPartitions() > len(by_part)


def test_cells_come_back_exactly():
    lines = np.array([
        [0, 1, -128, 127], [0, 1, 2, 128], [-32769, 1, 2, 3], [2**31, 1, 2, 3], [0.5, -1.25, 3, 4], [0.1, 2, 3, 4], [1e300, 0, 0, -0.0], [2**53, 1, 2, 3], [0, 0, 0, 0],
    ], float)
    kinds, cells = logistic.packed(lines)
    assert (logistic.unpacked(kinds, cells, 4) == lines).all()
    assert list(kinds) == [4, 3, 2, 1, 1, 0, 0, 1, 4]


def test_a_single_class_is_certain(data):
    model = train.fit_logistic(data.filter("y = 'a'"), NAMES, "y")
    assert score.score_matrix(data, model).filter("probability = 1.0 AND predicted_class = 'a'").count() == 900


def test_model_stored_by_spark_is_still_read(spark, data, tmp_path):
    new = train.fit_logistic(data, NAMES, "y")
    old = train.Classifier("logistic", spark_fit(data), NAMES, new.classes, scaler=new.scaler)
    for kind, model in (("old", old), ("new", new)):
        model.save(spark, str(tmp_path / kind))
        again = train.Classifier.load(spark, str(tmp_path / kind))
        assert type(again.model) is type(model.model)
        assert np.array_equal(again.model.coefficientMatrix.toArray(), model.model.coefficientMatrix.toArray())


@pytest.mark.parametrize("column, value, message", [("y", "cast(null as string)", "Labels MUST NOT"), ("weight", "-1.0D", "Weights MUST NOT"), ("x2", "double('nan')", "Vector values MUST NOT")])
def test_rows_that_cannot_be_learnt_from_are_errors(data, column, value, message):
    odd = data.withColumn(column, F.expr(f"CASE WHEN event_id = '5' THEN {value} ELSE {column} END"))
    with pytest.raises(Exception, match=message):
        train.fit_logistic(odd, NAMES, "y", classes=["a", "b", "c"])
