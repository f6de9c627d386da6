"""Boosting: shared columns, siblings by difference, and rounds in one task or over the executors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.operators import boosting, train, trees
from tests.test_models import NAMES, data, reference_boosting  # noqa: F401


def weighted(data, classes):  # noqa: F811
    other = 2 if classes == 3 else 0
    labels = F.when(F.col("y") == "a", 0).when(F.col("y") == "b", 1).otherwise(other)
    rows = data.repartition(3).withColumns({"label": labels, "weight": F.lit(1.0) + F.abs("x4"), "flag": (F.col("x1") > 0).cast("double")})
    return rows.withColumn("features", train.feature_vector([*NAMES, "flag"]))


@pytest.mark.parametrize("classes, direct", [(3, 64_000_000), (2, 64_000_000), (3, 5_000), (3, 0)])
def test_spread_rounds_against_plain_arrays(spark, data, monkeypatch, classes, direct):  # noqa: F811
    """Rounds over the executors: sums on the driver, merged sums, and splits that are chosen on the executors."""
    for name, value in {"LOCAL": 0, "DIRECT": direct, "MERGED": 2, "BLOCK_ROWS": 50, "REFRESH": 2}.items():
        monkeypatch.setattr(boosting, name, value)
    rows = weighted(data, classes)
    model = boosting.fit(rows, "features", "label", classes, "weight", rounds=5, depth=3, bins=16)
    found = rows.collect()
    x = np.array([[r[n] for n in [*NAMES, "flag"]] for r in found])
    y, w = np.array([r["label"] for r in found]), np.array([r["weight"] for r in found])
    want = reference_boosting(x, y, w, classes, boosting.bin_edges(rows, "features", 5, 16), 5, 3, 0.1)
    assert np.allclose(model.trees.answers(x).T, want[-1], atol=1e-8)


def test_small_tables_need_no_job_per_level(spark, data):  # noqa: F811
    rows = weighted(data, 3).cache()
    rows.count()
    spark.sparkContext.setJobGroup("few", "boosting of a small table")
    try:
        model = boosting.fit(rows, "features", "label", 3, "weight", rounds=12, depth=3, bins=16)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.trees.start) == 1 + 3 * 12
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few")) < 12


def test_columns_of_codes_keep_every_bin():
    rng = np.random.default_rng(0)
    counts = [64, 3, 1, 2, 256, 5, 17, 1]
    bins = np.stack([rng.integers(0, c, 500) for c in counts]).astype(np.uint8)
    known = boosting.Codes(counts)
    assert len(known.widths) < len(counts) and max(known.widths) <= boosting.CODES
    codes, weight, node = known.pack(bins), rng.random(500), rng.integers(0, 2, 500)
    sums = np.zeros((len(known.widths), 2, 2, boosting.CODES))
    for column, own in zip(codes, sums):
        for k, part in enumerate((weight, 2 * weight)):
            own[k] += np.bincount(node * boosting.CODES + column, part, 2 * boosting.CODES).reshape(2, -1)
    found = known.by_feature(sums)
    for n in range(2):
        want = np.concatenate([np.bincount(b[node == n], weight[node == n], c) for b, c in zip(bins, counts)])
        assert np.allclose(found[n, 0], want) and np.allclose(found[n, 1], 2 * want)
    tree = boosting.Tree()
    tree.split(0, 6, 8, (0.0, 0.0), (0.0, 0.0))
    tree.split(2, 3, 0, (0.0, 0.0), (0.0, 0.0))
    want = np.where(bins[6] <= 8, 1, np.where(bins[3] <= 0, 3, 4))
    assert (boosting.placed(codes, known.tests(tree)) == want).all()


def test_one_of_two_siblings_is_added_up():
    """The histogram of the other is the difference to their parent."""
    rng = np.random.default_rng(0)
    counts = [16, 2, 9]
    bins = np.stack([rng.integers(0, c, 900) for c in counts]).astype(np.uint8)
    known = boosting.Codes(counts)
    label = (bins[0] > 3).astype(np.int32) + (bins[2] > 6)
    rows, asked = boosting.Held([(label, np.ones(900), known.pack(bins), np.zeros((3, 900)))], known), []
    added = rows.sums
    rows.sums = lambda todo: (asked.append(sum(map(len, todo.open))), added(todo))[1]
    search = boosting.Search(counts, 16, 1.0, 1.0)
    boosting.grow(boosting.Level(rows, known, search, rows.probe()), 3, 3, 0.1, np.zeros(3))
    assert asked[0] == 3 and asked[1] == 3  # one of each two children of three roots


def test_first_of_equal_splits():
    """Features that part the rows alike gain the same, whatever the order of additions."""
    search = boosting.Search([3, 3], 16, 1.0, 0.0)
    sums = np.array([[-3.0, 1.0, 2.0, -3.0, 1.0, 2.0], [2.0, 2.0, 2.0, 2.0, 2.0, 2.0]])
    for step in (0.0, 1e-13, -1e-13):
        noisy = sums.copy()
        noisy[0, 3:] *= 1 + step
        assert search.best(noisy)[:2] == (0, 0)


def test_answers_do_not_depend_on_how_rows_are_taken(monkeypatch):
    """Rows go to their leaves some at a time; missing values go right, a leaf may have no, one or several outputs."""
    flat = trees.FlatTrees(
        3, np.array([0, 5, 6]), np.array([0, -1, 1, -1, -1, -1]), np.array([0.5, 0, -0.2, 0, 0, 0]), np.array([1, -1, 3, -1, -1, -1]),
        np.array([2, -1, 4, -1, -1, -1]), np.ones(6), np.array([0, 0, 1, 1, 3, 3, 4]), np.array([1, 0, 2, 0]), np.array([9.0, 1.0, 2.0, 0.5]),
    )
    rows = np.random.default_rng(0).normal(size=(50, 2))
    rows[3], rows[4, 1] = np.nan, np.nan
    want = np.zeros((50, 3))
    for line, (a, b) in zip(want, rows):
        line[0] += 0.5
        if a <= 0.5:
            line[1] += 9.0
        elif b <= -0.2:
            line[[0, 2]] += 1.0, 2.0
    for at_once, steps in ((4096, 5), (7, 1), (7, 9)):
        monkeypatch.setattr(trees, "AT_ONCE", at_once)
        monkeypatch.setattr(trees, "STEPS", steps)
        assert np.array_equal(flat.answers(rows), want)
    assert flat.answers(rows[:0]).shape == (0, 3)
