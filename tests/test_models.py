from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.operators import boosting, evaluate, explain, features, score, train, trees
from flowlake.operators.explain import model_trees

NAMES = ["x1", "x2", "x3", "x4"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    label = np.where(x[:, 0] + x[:, 1] > 0.8, "c", np.where(x[:, 2] > 0, "b", "a"))
    rows = [(str(i), *map(float, r), str(y)) for i, (r, y) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "event_id string, x1 double, x2 double, x3 double, x4 double, y string").cache()


@pytest.fixture(scope="module")
def forest(data):
    return train.fit_forest(train.with_balanced_weight(data, "y"), NAMES, "y", trees=4, depth=5)


@pytest.fixture(scope="module")
def logistic(data):
    return train.fit_logistic(train.with_balanced_weight(data, "y"), NAMES, "y")


def accuracy(df, model):
    return evaluate.class_report(score.score_matrix(df, model), "y", "predicted_class").first()["accuracy"]


def test_labels_are_alphabetical(data):
    classes = train.label_classes(data, "y")
    assert classes == ["a", "b", "c"]
    row = train.encode_label(data.withColumn("y", F.lit("unseen")), "y", classes).first()
    assert row["label_index"] is None
    assert train.encode_label(data.filter("y = 'c'"), "y", classes).first()["label_index"] == 2.0


def test_manual_weight_of_an_unknown_class_fails(data):
    with pytest.raises(Exception, match="no weight for class"):
        train.with_manual_weight(data, "y").collect()
    found = train.with_manual_weight(data, "y", {"a": 1.0, "b": 2.0, "c": 3.0})
    assert {(r["y"], r["weight"]) for r in found.collect()} == {("a", 1.0), ("b", 2.0), ("c", 3.0)}


def test_models_learn(data, forest, logistic):
    assert accuracy(data, forest) > 0.85 and accuracy(data, logistic) > 0.85


def test_boosted_models(data):
    weighted = train.with_balanced_weight(data, "y")
    many = train.fit_boosted(weighted, NAMES, "y", rounds=5, depth=3)
    assert accuracy(data, many) > 0.85
    p = score.score_matrix(data, many).first()["probabilities"]
    assert sum(p) == pytest.approx(1.0) and len(p) == 3
    two = train.fit_boosted_binary(data, NAMES, "y", F.col("y") == "c", ("rest", "c"), rounds=5, depth=3)
    found = score.score_matrix(data, two).withColumn("same", (F.col("y") == "c") == (F.col("predicted_class") == "c"))
    assert found.filter("same").count() > 540


def test_saved_model_scores_alike(spark, data, logistic, forest, tmp_path):
    many = train.fit_boosted(data, NAMES, "y", weight=None, rounds=2, depth=2)
    two = train.fit_boosted_binary(data, NAMES, "y", F.col("y") == "c", ("rest", "c"), rounds=2, depth=2)
    for model in (logistic, forest, many, two):
        path = str(tmp_path / model.kind)
        model.save(spark, path)
        again = train.Classifier.load(spark, path)
        assert (again.features, again.classes, again.version) == (model.features, model.classes, model.version)
        one = score.score_matrix(data, model).select("event_id", "probability").orderBy("event_id").collect()
        two = score.score_matrix(data, again).select("event_id", "probability").orderBy("event_id").collect()
        assert one == two


def test_importance_is_ranked(spark, data, forest, logistic):
    for model in (forest, logistic):
        values = [r["importance"] for r in train.feature_importance(model, spark).collect()]
        assert len(values) == 4 and values == sorted(values, reverse=True)
    assert train.feature_importance(forest, spark, 2).count() == 2


# ---- explanation -------------------------------------------------------------


def paid(flat, node, row, known):
    """What a subtree pays if only the ``known`` features are seen; the others follow the training weights."""
    if flat.feature[node] < 0:
        return flat.dense(np.array([node]))[0]
    f, left, right = flat.feature[node], flat.left[node], flat.right[node]
    if f in known:
        return paid(flat, left if row[f] <= flat.cut[node] else right, row, known)
    return sum(flat.cover[c] / flat.cover[node] * paid(flat, c, row, known) for c in (left, right))


def brute_force(row, flat, count):
    """Shapley values from the definition: all coalitions of all features."""
    pay = {known: sum(paid(flat, root, row, known) for root in flat.start[:-1]) for size in range(count + 1) for known in combinations(range(count), size)}
    result = np.zeros((flat.outputs, count))
    for f in range(count):
        others = [g for g in range(count) if g != f]
        for size in range(count):
            for group in combinations(others, size):
                weight = factorial(size) * factorial(count - size - 1) / factorial(count)
                result[:, f] += weight * (pay[tuple(sorted((*group, f)))] - pay[group])
    return result


def random_trees(rng, count, features, depth, outputs, chain=False):
    """Trees of any shape; features come again on a path; several leaves pay several outputs."""
    parts = []
    for _ in range(count):
        feature, cut, left, right, cover, values = [], [], [], [], [], []

        def make(weight, level):
            node = len(feature)
            for column in (feature, cut, left, right, cover, values):
                column.append(-1)
            cover[node] = weight
            if level < depth and (chain or rng.random() < 0.8):
                feature[node], cut[node] = int(rng.integers(features)), float(rng.normal())
                share = rng.uniform(0.1, 0.9)
                left[node] = make(weight * share, depth if chain else level + 1)
                right[node] = make(weight * (1 - share), level + 1)
            else:
                values[node] = rng.normal(size=outputs)
            return node

        make(100.0, 0)
        leaf = np.array([f < 0 for f in feature])
        flat = np.concatenate([v for v, is_leaf in zip(values, leaf) if is_leaf])
        starts = np.concatenate([[0], np.cumsum(leaf * outputs)])
        parts.append(trees.FlatTrees(
            outputs, np.array([0, len(feature)]), np.array(feature), np.array(cut, float), np.array(left), np.array(right), np.array(cover),
            starts, np.tile(np.arange(outputs), int(leaf.sum())), flat,
        ))
    return trees.FlatTrees.joined(parts, outputs)


@pytest.mark.parametrize("together", [1, 4096])
def test_tree_values_equal_the_definition(monkeypatch, together):
    monkeypatch.setattr(trees, "TOGETHER", together)
    rng = np.random.default_rng(together)
    for outputs in (1, 3):
        flat = random_trees(rng, 6, 4, 5, outputs)
        rows = rng.normal(size=(9, 4))
        found = trees.contributions(rows, flat)
        for i, row in enumerate(rows):
            assert np.allclose(found[i], brute_force(row, flat, 4), atol=1e-12)
            assert np.allclose(flat.answers(rows)[i], sum(paid(flat, r, row, range(4)) for r in flat.start[:-1]))
        own = rng.integers(0, outputs, 9)
        assert np.allclose(trees.own_contributions(rows, flat, own), found[np.arange(9), own], atol=1e-12)


def test_deep_chain_adds_up():
    """Sixty tests on one path, the same features again and again; many rows, walked in parts."""
    rng = np.random.default_rng(8)
    flat = random_trees(rng, 2, 12, 60, 2, chain=True)
    rows = rng.normal(size=(300, 12))
    base = sum(paid(flat, r, rows[0], ()) for r in flat.start[:-1])
    assert np.allclose(trees.contributions(rows, flat).sum(axis=2) + base, flat.answers(rows), atol=1e-9)


def test_spark_forest_equals_the_definition(spark, data, forest):
    flat = model_trees(spark, forest)
    rows = np.array([[r[n] for n in NAMES] for r in data.limit(4).collect()])
    found = trees.contributions(rows, flat)
    for i, row in enumerate(rows):
        assert np.allclose(found[i], brute_force(row, flat, 4), atol=1e-12)
    scored = np.array([r["probabilities"] for r in score.score_matrix(data.limit(4), forest).collect()])
    assert np.allclose(np.sort(flat.answers(rows), axis=0), np.sort(scored, axis=0))


# ---- boosting ----------------------------------------------------------------


def reference_boosting(x, y, weight, classes, edges, rounds, depth, rate, l2=1.0, least=1.0):
    """The same algorithm on plain arrays, node by node; margins after each round."""
    outputs = classes if classes > 2 else 1
    margins, history = np.zeros((outputs, len(y))), []
    for _ in range(rounds):
        if outputs == 1:
            p = 1 / (1 + np.exp(-margins))
            grads, hesses = (p - (y == 1)) * weight, p * (1 - p) * weight
        else:
            p = np.exp(margins) / np.exp(margins).sum(axis=0)
            grads, hesses = (p - (np.arange(outputs)[:, None] == y)) * weight, 2 * p * (1 - p) * weight
        for k in range(outputs):
            nodes = [(np.arange(len(y)), 0)]
            while nodes:
                rows, level = nodes.pop()
                g, h = grads[k, rows], hesses[k, rows]
                best = (1e-9, None)
                for f in range(x.shape[1] if level < depth else 0):
                    for cut in edges[f]:
                        side = x[rows, f] <= cut
                        gl, hl, gr, hr = g[side].sum(), h[side].sum(), g[~side].sum(), h[~side].sum()
                        gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - g.sum() ** 2 / (h.sum() + l2)
                        if hl >= least and hr >= least and gain > best[0] * (1 + 1e-9):
                            best = (gain, side)
                if best[1] is None:
                    margins[k, rows] += -rate * g.sum() / (h.sum() + l2)
                else:
                    nodes += [(rows[best[1]], level + 1), (rows[~best[1]], level + 1)]
        history.append(margins.copy())
    return history


@pytest.mark.parametrize("classes, direct", [(3, 64_000_000), (2, 64_000_000), (3, 0)])
def test_boosting_against_plain_arrays(spark, data, monkeypatch, classes, direct):
    """Also where histograms are merged by Spark, in two steps."""
    monkeypatch.setattr(boosting, "DIRECT", direct)
    monkeypatch.setattr(boosting, "MERGED", 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    weighted = data.repartition(3).withColumns({"label": F.when(F.col("y") == "a", 0).when(F.col("y") == "b", 1).otherwise(2 if classes == 3 else 0), "weight": F.lit(1.0) + F.abs("x4"), "features": train.feature_vector(NAMES)})
    rounds = 2 if direct == 0 else 5
    model = boosting.fit(weighted, "features", "label", classes, "weight", rounds=rounds, depth=3, bins=16)
    rows = weighted.collect()
    x, y, w = np.array([[r[n] for n in NAMES] for r in rows]), np.array([r["label"] for r in rows]), np.array([r["weight"] for r in rows])
    edges = boosting.bin_edges(weighted, "features", 4, 16)
    want = reference_boosting(x, y, w, classes, edges, rounds, 3, 0.1)
    assert np.allclose(model.trees.answers(x).T, want[-1], atol=1e-8)
    scored = model.transform(weighted).collect()
    p = np.array([list(r["probability"]) for r in scored])
    assert np.allclose(p.sum(axis=1), 1) and p.shape[1] == classes


def test_loss_falls_every_round(spark, data):
    weighted = train.with_balanced_weight(data, "y")
    losses = []
    for rounds in (1, 2, 4, 8, 16):
        model = train.fit_boosted(weighted, NAMES, "y", rounds=rounds, depth=3)
        place = F.array_position(F.array(*[F.lit(c) for c in model.classes]), F.col("y"))
        own = F.get("probabilities", (place - 1).cast("int"))
        losses.append(score.score_matrix(weighted, model).agg(F.sum(-F.log(own) * F.col("weight"))).first()[0])
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.5 * losses[0]


def test_boosting_odd_tables(spark, data):
    none = data.filter("false").withColumns({"label": F.lit(0), "features": train.feature_vector(NAMES)})
    assert len(boosting.fit(none, "features", "label", 3, rounds=2).trees.start) == 1
    same = spark.createDataFrame([(i % 3, 1.0, float("nan")) for i in range(30)], "label int, a double, b double")
    same = same.withColumn("features", train.feature_vector(["a", "b"]))
    model = boosting.fit(same, "features", "label", 3, rounds=2)
    assert np.allclose([list(r["probability"]) for r in model.transform(same).collect()], 1 / 3)
    with pytest.raises(ValueError, match="bytes"):
        boosting.fit(same, "features", "label", 3, bins=300)


def test_blocks_of_one_file_are_dealt_over_the_cores(spark, data, monkeypatch):
    """Rows that come in one part are added up by all cores, and only bins that a feature has are sent."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    rows = data.coalesce(1).withColumns({"label": F.when(F.col("y") == "a", 0).otherwise(1), "flag": F.lit(7.0)})
    rows = rows.withColumn("features", train.feature_vector(["x1", "flag"]))
    edges = boosting.bin_edges(rows, "features", 2, 16)
    blocks, parts = boosting.dealt(boosting.store_blocks(rows, "features", "label", None, edges, 1))
    cores = spark.sparkContext.defaultParallelism
    assert parts == cores and len(blocks.groupBy(F.spark_partition_id()).count().collect()) > 1
    counts = [len(e) + 1 for e in edges]
    todo = boosting.Pass(1, counts, 16, [], [boosting.Tree()], [[0]])
    sums = todo.histograms(iter(blocks.toArrow().to_batches()))
    assert sums.shape == (1, 2, sum(counts)) and sum(counts) < 2 * 16
    labels = np.array([r["label"] for r in rows.collect()])
    assert np.allclose(sums[0, 0, :counts[0]].sum(), (0.5 - labels).sum()) and np.allclose(sums[0, 1, counts[0]:].sum(), 0.25 * len(labels))


@pytest.mark.parametrize("kind", ["forest", "boosted_binary", "boosted"])
def test_contributions_add_up(spark, data, forest, kind):
    model = {
        "forest": lambda: forest,
        "boosted_binary": lambda: train.fit_boosted_binary(
            data, NAMES, "y", F.col("y") == "c", ("rest", "c"), rounds=4, depth=3
        ),
        "boosted": lambda: train.fit_boosted(data, NAMES, "y", weight=None, rounds=3, depth=2),
    }[kind]()
    found = explain.forest_contributions(data.limit(40), model, ["event_id"])
    sums = {r["event_id"]: [sum(c) for c in r["contributions"]] for r in found.collect()}
    scored = model.model.transform(model._vectors(data.limit(40))).collect()
    column = "probability" if kind == "forest" else "rawPrediction"
    index = {"forest": range(3), "boosted_binary": [1], "boosted": range(3)}[kind]
    outputs = {r["event_id"]: [float(r[column][i]) for i in index] for r in scored}
    gaps = np.array([np.array(outputs[e]) - np.array(sums[e]) for e in sums])
    # What is left is the same base value for every row.
    assert np.abs(gaps - gaps[0]).max() < 1e-9


def test_linear_contributions_add_up(data, logistic):
    found = explain.linear_contributions(data.limit(30), logistic).collect()
    weights = logistic.model.coefficientMatrix.toArray()
    mean, std = logistic.scaler.mean.toArray(), logistic.scaler.std.toArray()
    for r in found:
        x = (np.array([r[n] for n in NAMES]) - mean) / std
        assert np.allclose(np.array(r["contributions"]), weights * x, atol=1e-10)


def test_global_table(data, forest, logistic):
    for model in (forest, logistic):
        rows = explain.global_importance(data, model).collect()
        assert {r["class"] for r in rows} == {"a", "b", "c", "Overall"} and len(rows) == 16
        for name in ("a", "Overall"):
            mine = sorted((r for r in rows if r["class"] == name), key=lambda r: r["feature_rank"])
            assert [r["feature_rank"] for r in mine] == [1, 2, 3, 4]
            values = [r["mean_abs_shap"] for r in mine]
            assert values == sorted(values, reverse=True)
        x1 = {r["class"]: r["mean_abs_shap"] for r in rows if r["feature"] == "x1"}
        assert x1["Overall"] == pytest.approx((x1["a"] + x1["b"] + x1["c"]) / 3)


def test_global_table_is_the_mean_of_the_rows(data, forest):
    rows = explain.forest_contributions(data, forest, ["event_id"]).collect()
    mean = np.abs(np.array([r["contributions"] for r in rows])).mean(axis=0)
    table = {(r["class"], r["feature"]): r["mean_abs_shap"] for r in explain.global_importance(data, forest).collect()}
    for c, name in enumerate("abc"):
        for f, feature in enumerate(NAMES):
            assert table[(name, feature)] == pytest.approx(mean[c, f])


def test_local_explanation_is_of_the_predicted_class(data, forest, logistic):
    for model in (forest, logistic):
        scored = score.score_matrix(data.limit(20), model)
        found = explain.explain_rows(scored, model, ["event_id"], k=3).collect()
        assert len(found) == 20
        for r in found:
            sizes = [abs(t["shap_contribution"]) for t in r["top_features"]]
            assert len(sizes) == 3 and sizes == sorted(sizes, reverse=True)


# ---- scoring of flows --------------------------------------------------------


def test_scored_flows_and_tables(spark, flows):
    encoder = features.FlowEncoder.fit(flows)
    matrix = encoder.transform(flows, ["event_id", "attack_type"])
    model = train.fit_forest(matrix, encoder.columns, "attack_type", weight=None, trees=3, depth=4, encoder=encoder, version="7")
    scored = score.score_flows(flows, model)
    row = scored.first()
    assert row["model_version"] == "7" and row["schema_version"] == "1.0.1"
    assert row["probability"] == pytest.approx(max(row["all_probabilities"].values()))
    predictions = score.as_predictions(scored)
    stored = score.stored(predictions, score.PREDICTIONS_SCHEMA)
    assert stored.dtypes == [(f.name, f.dataType.simpleString()) for f in score.PREDICTIONS_SCHEMA]
    alerts = score.stored(score.as_alerts(predictions), score.ALERTS_SCHEMA)
    assert alerts.filter("predicted_class = 'Benign'").count() == 0
    assert alerts.count() == predictions.filter("predicted_class <> 'Benign'").count()
    # Fewer columns still score; none at all is an error.
    assert score.score_flows(flows.drop("Rate", "sDSb"), model).count() == flows.count()
    with pytest.raises(ValueError):
        score.score_flows(flows.select("event_id"), model)
