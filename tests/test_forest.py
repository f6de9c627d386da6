import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.operators import forest, train

NAMES = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 3)).round(1)
    noisy = rng.random(900) < 0.2
    label = np.where(noisy, rng.integers(0, 3, 900), np.where(x[:, 0] + x[:, 1] > 0.5, 2, x[:, 2] > 0))
    rows = [(int(y), float(rng.uniform(0.5, 2)), *map(float, r)) for y, r in zip(label, x)]
    table = spark.createDataFrame(rows, "label int, weight double, x1 double, x2 double, x3 double")
    return table.withColumn("features", train.feature_vector(NAMES)).cache()


def reference(bins, labels, weights, classes, depth):
    """Answers of a tree that looks at all features, grown node by node; siblings that say the same become one."""
    def make(rows, level):
        stats = np.bincount(labels[rows], weights[rows], classes)
        total, best = stats.sum(), (1e-9, None)
        if level < depth and (stats > 0).sum() > 1:
            for f in range(len(bins)):
                for cut in np.unique(bins[f, rows])[:-1]:
                    side = bins[f, rows] <= cut
                    a, b = (np.bincount(labels[rows[s]], weights[rows[s]], classes) for s in (side, ~side))
                    gain = ((a**2).sum() / a.sum() + (b**2).sum() / b.sum() - (stats**2).sum() / total) / total
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (f, cut, side))
        if best[1] is None:
            return {"leaf": True, "stats": stats}
        f, cut, side = best[1]
        left, right = make(rows[side], level + 1), make(rows[~side], level + 1)
        if left["leaf"] and right["leaf"] and left["stats"].argmax() == right["stats"].argmax():
            return {"leaf": True, "stats": stats}
        return {"leaf": False, "split": (f, cut), "left": left, "right": right, "stats": stats}

    root = make(np.arange(len(labels)), 0)

    def answer(row):
        node = root
        while not node["leaf"]:
            f, cut = node["split"]
            node = node["left"] if row[f] <= cut else node["right"]
        return node["stats"]

    return np.array([answer(row) for row in bins.T])


@pytest.mark.parametrize("depth", [0, 1, 4, 12])
def test_subtree_against_plain_arrays(depth):
    rng = np.random.default_rng(depth)
    bins, labels, weights = rng.integers(0, 16, (4, 700)).astype(np.uint8), rng.integers(0, 3, 700), rng.uniform(0.1, 3, 700)
    labels = np.where(bins[0] > 7, labels, 0)
    plan = forest.Plan([16] * 4, 3, 16, 4, depth, 1)
    found = forest.grow_below(plan, 0, 1, labels, weights, bins)
    flat = forest.flat(found, [np.arange(15.0)] * 4, 1.0)
    want = reference(bins, labels, weights, 3, depth)
    assert np.allclose(flat.answers(bins.T.astype(float)), want / want.sum(axis=1, keepdims=True))
    # A subtree below another node ends where the whole tree's depth does.
    if depth:
        lower = forest.flat(forest.grow_below(plan, 0, 2, labels, weights, bins), [np.arange(15.0)] * 4, 1.0)
        want = reference(bins, labels, weights, 3, depth - 1)
        assert np.allclose(lower.answers(bins.T.astype(float)), want / want.sum(axis=1, keepdims=True))


@pytest.mark.parametrize("local, sums, together", [(200, 64_000_000, 4_000_000_000), (25, 1, 1)])
def test_upper_levels_and_subtrees_make_the_same_trees(spark, data, monkeypatch, local, sums, together):
    """Whether nodes are split by merged histograms or inside a group; also trees one by one and histograms one by one."""
    fit = lambda: forest.fit(data, "features", "label", 3, "weight", trees=2, depth=7, bins=16)
    monkeypatch.setattr(forest.math, "sqrt", lambda width: width)  # all features, so that nothing but the samples is drawn
    one = fit()
    monkeypatch.setattr(forest, "LOCAL", local)
    monkeypatch.setattr(forest, "SUMS", sums)
    monkeypatch.setattr(forest, "TOGETHER", together)
    two = fit()
    rows = np.array([[r[n] for n in NAMES] for r in data.collect()])
    assert np.allclose(one.trees.answers(rows), two.trees.answers(rows))
    assert np.allclose(one.importances, two.importances)


def test_large_pure_node_is_a_leaf_without_a_group(spark, data, monkeypatch):
    monkeypatch.setattr(forest, "LOCAL", 50)
    pure = data.withColumn("label", (F.col("x1") > 0).cast("int"))
    model = forest.fit(pure, "features", "label", 2, "weight", trees=1, depth=5)
    rows = pure.collect()
    found = model.trees.answers(np.array([[r[n] for n in NAMES] for r in rows]))
    assert len(model.trees.feature) == 3 and (found.argmax(axis=1) == [r["label"] for r in rows]).all()


def test_samples_differ_by_tree_and_block_and_repeat():
    plan = forest.Plan([4], 2, 4, 1, 3, 42)
    one = plan.drawn(3, 1 << 33, 5000)
    assert (one == plan.drawn(3, 1 << 33, 5000)).all() and abs(one.mean() - 1) < 0.06 and abs(one.var() - 1) < 0.12
    assert (one != plan.drawn(4, 1 << 33, 5000)).any() and (one != plan.drawn(3, 1, 5000)).any()


def test_forest_deeper_than_thirty(spark):
    """A chain: every test cuts off one value, so a tree of depth 40 is needed; Spark's own forest refuses it."""
    rows = spark.createDataFrame([(i % 2, float(i), 1.0 + 3.0**min(i, 30)) for i in range(45)], "y int, x double, w double")
    rows = rows.withColumn("y", F.col("y").cast("string"))
    model = train.fit_forest(rows, ["x"], "y", weight="w", trees=3, depth=40)
    assert model.model.trees.start[-1] > 3
    with pytest.raises(ValueError, match="no rows"):
        train.fit_forest(rows.filter("false"), ["x"], "y", weight=None, classes=["0", "1"])


@pytest.mark.parametrize(
    "column, value, message",
    [
        ("label", "cast(null as int)", "Labels MUST NOT"), ("weight", "cast(null as double)", "Weights MUST NOT"), ("weight", "-1.0D", "Weights MUST NOT"),
        ("weight", "double('nan')", "Weights MUST NOT"), ("x2", "double('nan')", "Vector values MUST NOT"), ("x2", "double('inf')", "Vector values MUST NOT"),
    ],
)
def test_rows_that_cannot_be_learnt_from_are_errors(data, column, value, message):
    """One such row among many is not left out."""
    odd = data.withColumn(column, F.expr(f"CASE WHEN x1 = 0 THEN {value} ELSE {column} END"))
    odd = odd.withColumn("features", train.feature_vector(NAMES))
    with pytest.raises(Exception, match=message):
        forest.fit(odd, "features", "label", 3, "weight", trees=1, depth=2)


def test_stored_forest_comes_in_pieces(spark, tmp_path, monkeypatch):
    """A task is sent a bounded part of the nodes, whatever the size of the forest or of a tree."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    rows = [(int(i % 3), *map(float, r)) for i, r in enumerate(x)]
    frame = spark.createDataFrame(rows, "label int, a double, b double, c double").withColumn("features", train.feature_vector(["a", "b", "c"]))
    model = forest.fit(frame, "features", "label", 3, None, trees=5, depth=8)
    monkeypatch.setattr(forest, "PIECE", 20)
    monkeypatch.setattr(forest, "WRITTEN", 4000)
    path = str(tmp_path / "forest")
    model.save(spark, path)
    stored = spark.read.parquet(path)
    assert stored.selectExpr("max(size(feature))").first()[0] <= 20 < np.diff(model.trees.start).max()
    assert stored.select(F.input_file_name()).distinct().count() == stored.count() > 5
    again = forest.ForestModel.load(spark, path)
    for name, value in vars(model.trees).items():
        assert np.array_equal(getattr(again.trees, name), value)
    assert np.array_equal(again.gains, model.gains)
    part = str(tmp_path / "part")
    stored.filter("tree < 4").write.parquet(part)
    with pytest.raises(ValueError, match="not complete"):
        forest.ForestModel.load(spark, part)
    old = str(tmp_path / "old")
    monkeypatch.setattr(forest, "PIECE", 1_000_000)
    model.save(spark, old + "-whole")
    spark.read.parquet(old + "-whole").drop("piece", "forest_nodes").write.parquet(old)
    assert np.array_equal(forest.ForestModel.load(spark, old).trees.leaf_value, model.trees.leaf_value)
