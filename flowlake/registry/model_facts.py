"""Facts about fitted models that SQL can state.

The models' own figures are in ``model_checks``; here each is asked what must be true of
it: the rows it answers for, sums of probabilities, completeness of ranks, additivity; and what only the
right model meets: no slope at the fit, a loss that falls with the rounds, trees that answer as
the model does, importance from the stored gains.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml import functions as MF
from pyspark.sql import Window, functions as F

from flowlake.operators import explain, score, train
from flowlake.plans import kpi
from flowlake.operators import evaluate
from flowlake.registry import model_checks as models
from flowlake.registry.core import on_flows, query

ORDER = "md5(concat(event_id, '|42'))"
PARTS_SQL = f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY attack_type ORDER BY {ORDER}, event_id) AS r,
    count(*) OVER (PARTITION BY attack_type) AS n FROM flows),
  parts AS (SELECT *, CASE WHEN r <= (n * 70 + 50) // 100 THEN 'train' WHEN r <= (n * 85 + 50) // 100 THEN 'val' ELSE 'test' END AS split FROM ranked)
"""
SUPPORT = on_flows(PARTS_SQL + "SELECT attack_type AS class, count(*) AS support FROM parts WHERE split = 'val' GROUP BY 1")
CLASSES_SQL = on_flows("SELECT DISTINCT attack_type AS class, true AS additive FROM flows")


def _support(name, model, oracle=SUPPORT):
    @query(name, oracle)
    def _(t):
        report = models._report(t, model(t))
        return report.filter(F.col("class").isin(model(t).classes) & (F.col("support") > 0)).select("class", "support")


_support("m10_support", models._logistic)
_support("m11_support", models._forest)
_support("m12_support", models._boosted)
_support("m15_support", models._manual)


def _sound(scored, classes):
    """Rows, distinct ids, and rows whose probabilities add up to 1 and whose class has the largest."""
    p = F.col("probabilities")
    names = F.array(*[F.lit(c) for c in classes])
    own = F.get(p, (F.array_position(names, F.col("predicted_class")) - 1).cast("int"))
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"),
        F.count_if(F.abs(total - 1) < 1e-9).alias("sum_to_one"), F.count_if(own == F.array_max(p)).alias("most_probable"),
    )


SOUND = "SELECT count(*) AS n, count(*) AS ids, count(*) AS sum_to_one, count(*) AS most_probable FROM parts WHERE "


@query("m13_probabilities", on_flows(PARTS_SQL + SOUND + "split = 'val'"))
def _(t):
    model = models._malicious(t)
    return _sound(score.score_matrix(models._part(t, "val"), model), model.classes)


@query("m14_probabilities", on_flows(PARTS_SQL + SOUND + "split = 'val' AND attack_type IN ('Benign', 'UDPFlood')"))
def _(t):
    model = models._specialist(t)
    return _sound(score.score_matrix(train.class_subset(models._part(t, "val"), "attack_type", models.PAIR), model), model.classes)


@query("m16_probabilities", on_flows(PARTS_SQL + SOUND + "split = 'test'"))
def _(t):
    model = models._forest(t)
    return _sound(score.score_matrix(models._part(t, "test"), model), model.classes)


@query("m16_every_flow_once", on_flows("SELECT count(*) AS predictions, count(*) AS ids, count(*) AS complete FROM flows"))
def _(t):
    stored = score.stored(score.as_predictions(score.score_flows(t.flows, models._forest(t))), score.PREDICTIONS_SCHEMA)
    complete = F.col("predicted_class").isNotNull() & F.col("probability").between(0, 1) & F.col("flow_timestamp").isNotNull()
    return stored.agg(F.count(F.lit(1)).alias("predictions"), F.count_distinct("event_id").alias("ids"), F.count_if(complete).alias("complete"))


# ---- what only the right model meets -----------------------------------------

TRAINED = on_flows(PARTS_SQL + "SELECT count(*) AS train_rows, true AS holds FROM parts WHERE split = 'train'")


def _holds(t, holds):
    return models._part(t, "train").agg(F.count(F.lit(1)).alias("train_rows")).withColumn("holds", F.lit(bool(holds)))


def _gradient(rows, model, weight):
    """Largest entry of the gradient of the mean loss plus penalty, at the fitted weights."""
    vectors = model._vectors(train.encode_label(rows, "attack_type", model.classes))
    scored = model.model.transform(vectors).select("label_index", F.col(weight).alias("w"), MF.vector_to_array("features").alias("x"), MF.vector_to_array("probability").alias("p"))
    width, classes = len(model.features), len(model.classes)

    def add(batches):
        sums, total = np.zeros((classes, width + 1)), 0.0
        for batch in batches:
            n = batch.num_rows
            label, w = batch.column(0).to_numpy().astype(int), batch.column(1).to_numpy()
            x, p = (batch.column(i).flatten().to_numpy().reshape(n, -1) for i in (2, 3))
            sums += ((p - np.eye(classes)[label]) * w[:, None]).T @ np.concatenate([x, np.ones((n, 1))], axis=1)
            total += w.sum()
        yield pa.RecordBatch.from_pydict({"sums": [sums.ravel()], "total": [total]})

    parts = scored.mapInArrow(add, "sums array<double>, total double").collect()
    total = sum(r["total"] for r in parts)
    gradient = sum(np.array(r["sums"]) for r in parts).reshape(classes, -1) / total
    gradient[:, :-1] += model.model.coefficientMatrix.toArray() / total
    return float(np.abs(gradient).max())


@query("m10_stationary", TRAINED)
def _(t):
    """The penalised loss has no slope left where the fit stopped."""
    return _holds(t, _gradient(models._weighted(t), models._logistic(t), "weight") < 2e-3)


def _close(t, model, classes):
    """Rows on which the stored trees answer as the model does."""
    test, trees, softmax = models._part(t, "test"), explain.model_trees(t.spark, model), model.kind == "boosted"
    scored = score.score_matrix(test, model).select(F.array(*[F.col(f"`{c}`").cast("double") for c in model.features]).alias("x"), "probabilities")

    def compare(batches):
        for batch in batches:
            x, p = (c.flatten().to_numpy().reshape(batch.num_rows, -1) for c in batch.columns)
            found = trees.answers(x)
            if softmax:
                found = np.exp(found - found.max(axis=1, keepdims=True))
                found /= found.sum(axis=1, keepdims=True)
            yield pa.RecordBatch.from_pydict({"rows": [len(x)], "alike": [int((np.abs(found - p).max(axis=1) < 1e-9).sum())]})

    return scored.mapInArrow(compare, "rows bigint, alike bigint").agg(F.sum("rows").alias("rows"), F.sum("alike").alias("alike"))


ALIKE = on_flows(PARTS_SQL + "SELECT CAST(count(*) AS bigint) AS rows, CAST(count(*) AS bigint) AS alike FROM parts WHERE split = 'test'")


@query("m11_trees_answer", ALIKE)
def _(t):
    return _close(t, models._forest(t), models._forest(t).classes)


@query("m12_saved_trees_answer", ALIKE)
def _(t):
    path = t.scratch("boosted-model")
    models._boosted(t).save(t.spark, path)
    return _close(t, train.Classifier.load(t.spark, path), models._boosted(t).classes)


def _losses(rows, model, labels, weight, steps):
    """Training loss after some of the rounds."""
    trees, outputs = model.model.trees, model.model.trees.outputs
    vectors = rows.select(F.array(*[F.col(f"`{c}`").cast("double") for c in model.features]).alias("x"), labels.cast("int").alias("y"), weight.alias("w"))

    def add(batches):
        total = np.zeros(len(steps))
        for batch in batches:
            x, y, w = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            margins = np.zeros((len(x), outputs))
            for i, (first, last) in enumerate(zip([0, *steps], steps)):
                margins += trees.part(first * outputs, last * outputs).answers(x)
                wide = margins if outputs > 1 else np.concatenate([0 * margins, margins], axis=1)
                top = wide.max(axis=1)
                total[i] += (w * (np.log(np.exp(wide - top[:, None]).sum(axis=1)) + top - wide[np.arange(len(x)), y])).sum()
        yield pa.RecordBatch.from_pydict({"total": [total]})

    return np.sum([r["total"] for r in vectors.mapInArrow(add, "total array<double>").collect()], axis=0)


def _falling(name, of, rows, labels, weight):
    @query(name, TRAINED)
    def _(t):
        """The loss that is minimised falls with the rounds, and all rounds are there."""
        model = of(t)
        found = _losses(rows(t), model, labels(model), weight(), [1, 5, 20, 50, 100, 150, train.BOOSTING["rounds"]])
        whole = len(model.model.trees.start) - 1 == train.BOOSTING["rounds"] * model.model.trees.outputs
        return _holds(t, whole and (np.diff(found) < 0).all())


def _place(model):
    return F.array_position(F.array(*[F.lit(c) for c in model.classes]), F.col("attack_type")) - 1


def _manually(t):
    return train.with_manual_weight(models._part(t, "train"), "attack_type")


def _pair(t):
    return train.with_balanced_weight(train.class_subset(models._part(t, "train"), "attack_type", models.PAIR), "attack_type")


_falling("m12_loss_falls", models._boosted, models._weighted, _place, lambda: F.col("weight"))
_falling("m13_loss_falls", models._malicious, lambda t: models._part(t, "train"), lambda m: F.col("attack_type") != "Benign", lambda: F.lit(1.0))
_falling("m14_loss_falls", models._specialist, _pair, lambda m: F.col("attack_type") == models.PAIR[1], lambda: F.col("weight"))
_falling("m15_loss_falls", models._manual, _manually, _place, lambda: F.col("weight"))


@query("m20_gains_add_up", TRAINED)
def _(t):
    """Importance is the share of the gains stored with the trees, each weighted by its node, each tree alike."""
    model, path = models._forest(t), t.scratch("forest")
    model.model.save(t.spark, path)
    nodes = t.spark.read.parquet(path).select("tree", F.inline(F.arrays_zip("feature", "gain", "cover"))).filter("feature >= 0")
    by_tree = nodes.groupBy("tree", F.col("feature").alias("f")).agg(F.sum(F.col("gain") * F.col("cover")).alias("g"))
    share = F.col("g") / F.sum("g").over(Window.partitionBy("tree"))
    shares = by_tree.withColumn("share", share).groupBy("f").agg(F.sum("share").alias("share")).collect()
    total = sum(r["share"] for r in shares)
    want = {model.features[r["f"]]: r["share"] / total for r in shares}
    found = {r["feature"]: r["importance"] for r in train.feature_importance(model, t.spark).collect()}
    return _holds(t, len(found) == len(model.features) and all(abs(found[c] - want.get(c, 0.0)) < 1e-9 for c in found))


def _additive(t, found, outputs):
    """Output less contributions is the same number, the base, for all rows of a class."""
    rest = found.join(outputs, ["event_id", "class"]).withColumn("base", F.col("output") - F.col("total_contribution"))
    return rest.groupBy("class").agg(((F.max("base") - F.min("base")) < 1e-6).alias("additive"))


@query("m21_forest_additive", CLASSES_SQL)
def _(t):
    model = models._forest(t)
    test = models._part(t, "test").select("event_id", *[f"`{c}`" for c in models._encoder(t).columns])
    names = F.array(*[F.lit(c) for c in model.classes])
    outputs = score.score_matrix(test, model).select("event_id", F.posexplode("probabilities").alias("i", "output"))
    outputs = outputs.select("event_id", F.get(names, F.col("i")).alias("class"), "output")
    return _additive(t, models._long(explain.forest_contributions(test, model, ["event_id"]), model), outputs)


def _margins_additive(t, model, explained):
    """Differences of log-probabilities are differences of margins: each class against the first."""
    test = models._part(t, "test").select("event_id", *[f"`{c}`" for c in models._encoder(t).columns])
    names = F.array(*[F.lit(c) for c in model.classes])
    first = F.get("probabilities", F.lit(0))
    logs = F.transform("probabilities", lambda p: F.log(p) - F.log(first))
    outputs = score.score_matrix(test, model).filter(F.array_min("probabilities") > 1e-12).select("event_id", F.posexplode(logs).alias("i", "output"))
    outputs = outputs.select("event_id", F.get(names, F.col("i")).alias("class"), "output")
    long = models._long(explained(test, model), model)
    zero = long.filter(F.col("class") == model.classes[0]).select("event_id", F.col("total_contribution").alias("zero"))
    against = long.join(zero, "event_id").withColumn("total_contribution", F.col("total_contribution") - F.col("zero"))
    return _additive(t, against, outputs)


@query("m21_linear_additive", CLASSES_SQL)
def _(t):
    return _margins_additive(t, models._logistic(t), explain.linear_contributions)


@query("m21_boosted_additive", CLASSES_SQL)
def _(t):
    return _margins_additive(t, models._boosted(t), lambda test, model: explain.forest_contributions(test, model, ["event_id"]))


def _ranks(name, model):
    @query(name, on_flows("SELECT class, true AS complete, true AS falling, true AS overall_is_mean FROM (SELECT DISTINCT attack_type AS class FROM flows UNION SELECT 'Overall')"))
    def _(t):
        found = explain.global_importance(models._part(t, "test"), model(t))
        mean = found.filter("class <> 'Overall'").groupBy("feature").agg(F.avg("mean_abs_shap").alias("mean"))
        ordered = F.transform(F.sort_array(F.collect_list(F.struct("feature_rank", "mean_abs_shap"))), lambda x: x["mean_abs_shap"])
        same = (F.col("class") != "Overall") | (F.abs(F.col("mean_abs_shap") - F.col("mean")) < 1e-9)
        n = len(models._encoder(t).columns)
        return found.join(mean, "feature").groupBy("class").agg(
            ((F.count(F.lit(1)) == n) & (F.count_distinct("feature_rank") == n) & (F.max("feature_rank") == n)).alias("complete"),
            (ordered == F.sort_array(ordered, asc=False)).alias("falling"),
            F.bool_and(same).alias("overall_is_mean"),
        )


_ranks("m22_forest_ranks", models._forest)
_ranks("m22_linear_ranks", models._logistic)
_ranks("m22_boosted_ranks", models._boosted)


@query(
    "m23_five_per_row",
    on_flows(PARTS_SQL + "SELECT count(*) AS n, 5 * count(*) AS features, count(*) AS falling FROM parts WHERE split = 'test'"),
)
def _(t):
    model = models._boosted(t)
    found = explain.explain_rows(score.score_matrix(models._part(t, "test"), model), model, ["event_id"])
    sizes = F.transform("top_features", lambda x: F.abs(x["shap_contribution"]))
    return found.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size(F.array_distinct(F.transform("top_features", lambda x: x["feature"])))).alias("features"),
        F.count_if(sizes == F.sort_array(sizes, asc=False)).alias("falling"),
    )


@query(
    "b8_ten_ranks",
    on_flows("SELECT CAST(10 AS bigint) AS n, CAST(55 AS bigint) AS ranks, count(DISTINCT attack_type) AS classes FROM flows"),
)
def _(t):
    ranked = explain.global_importance(models._part(t, "test"), models._logistic(t))
    found = kpi.top_importance(ranked, 10).agg(F.count(F.lit(1)).alias("n"), F.sum("feature_rank").alias("ranks"))
    return found.join(F.broadcast(ranked.filter("class <> 'Overall'").agg(F.count_distinct("class").alias("classes"))))


@query("b10_support", on_flows(PARTS_SQL + "SELECT count(*) AS support, true AS shares FROM parts WHERE split = 'test'"))
def _(t):
    scored = score.score_matrix(models._part(t, "test"), models._logistic(t))
    card = kpi.model_card(evaluate.model_performance(scored, "attack_type", "predicted_class", "1"))
    shares = F.col("accuracy").between(0, 1) & F.col("macro_f1").between(0, 1) & F.col("weighted_f1").between(0, 1)
    return card.select(F.col("support").cast("bigint").alias("support"), shares.alias("shares"))


@query("t5_every_flow_scored", on_flows("SELECT count(*) AS predictions, count(*) AS ids FROM flows"))
def _(t):
    from flowlake.registry.core import QUERIES

    stored = QUERIES["t5_stream_scoring"](t.spark, t.folder)
    return stored.agg(F.count(F.lit(1)).alias("predictions"), F.count_distinct("event_id").alias("ids"))
