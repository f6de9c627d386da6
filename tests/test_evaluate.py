import numpy as np
import pytest

from flowlake.operators import evaluate, lookup, score


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "y string, p string")


def test_report_with_absent_sides(spark):
    df = scored(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a"), ("b", "d")])
    found = {r["class"]: r for r in evaluate.class_report(df, "y", "p").collect()}
    assert found["a"]["precision_score"] == 0.5 and found["a"]["recall_score"] == 0.5
    assert found["b"]["f1_score"] == pytest.approx(2 / 3)
    assert found["c"]["precision_score"] == 0.0 and found["c"]["f1_score"] == 0.0  # never predicted
    assert found["d"]["support"] == 0 and found["d"]["recall_score"] == 0.0  # never true
    row = found["a"]
    assert row["accuracy"] == 0.5
    assert row["macro_f1"] == pytest.approx((0.5 + 2 / 3) / 4)
    assert row["weighted_f1"] == pytest.approx((2 * 0.5 + 3 * 2 / 3) / 6)


def test_confusion_fills_missing_pairs(spark):
    df = scored(spark, [("a", "a"), ("b", "a")])
    rows = {r["label"]: (r["a"], r["b"], r["c"]) for r in evaluate.confusion_matrix(df, "y", "p", ["a", "b", "c"]).collect()}
    assert rows == {"a": (1, 0, 0), "b": (1, 0, 0)}


@pytest.mark.parametrize("seed", [0, 1])
def test_area_equals_pairwise_wins(spark, seed):
    rng = np.random.default_rng(seed)
    truth, points = rng.integers(0, 2, 80), rng.integers(0, 12, 80) / 10
    df = spark.createDataFrame([(int(t), float(p)) for t, p in zip(truth, points)], "t int, p double")
    pos, neg = points[truth == 1], points[truth == 0]
    wins = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    assert evaluate.roc_auc(df, "t", "p").first()[0] == pytest.approx(wins)


def test_area_of_one_class_is_unknown(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.6)], "t int, p double")
    assert evaluate.roc_auc(df, "t", "p").first()[0] is None


def test_sweep_equals_a_plain_loop(spark):
    rng = np.random.default_rng(2)
    classes = ["Benign", "SYNFlood", "UDPFlood"]
    probabilities = rng.dirichlet([1, 1, 2], 120)
    labels = rng.integers(0, 3, 120)
    df = spark.createDataFrame(
        [(classes[y], [float(v) for v in p]) for y, p in zip(labels, probabilities)], "y string, p array<double>"
    )
    found = evaluate.threshold_sweep(df, "y", "p", classes).collect()
    assert [r["threshold"] for r in found] == [round(0.3 + 0.05 * i, 2) for i in range(14)]
    for r, t in zip(found, evaluate.THRESHOLDS):
        best, second = probabilities.argmax(1), probabilities.argsort(1)[:, -2]
        guess = np.where((best == 2) & (probabilities[:, 2] <= t), second, best)
        f1 = [2 * ((guess == c) & (labels == c)).sum() / ((guess == c).sum() + (labels == c).sum()) for c in range(3)]
        assert r["macro_f1"] == pytest.approx(np.mean(f1))
        assert r["benign_recall"] == pytest.approx((guess[labels == 0] == 0).mean())
        assert r["udpflood_recall"] == pytest.approx((guess[labels == 2] == 2).mean())


def test_ties_go_to_the_first_class(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.2, 0.4, 0.4],)], "p array<double>")
    first, second = evaluate.top_two(df["p"], ["a", "b", "c"])
    best, _ = score.best_class("p", ["a", "b", "c"])
    assert [tuple(r) for r in df.select(first, second, best).collect()] == [("a", "b", "a"), ("b", "c", "b")]


def test_smoke_verdicts(spark):
    sent = spark.createDataFrame([("1", "Benign"), ("2", "SYNScan"), ("3", "SYNScan")], "event_id string, attack_type string")
    good = spark.createDataFrame([("1", "UDPFlood"), ("2", "SYNScan"), ("3", "SYNScan")], "event_id string, predicted_class string")
    row = evaluate.smoke_verdicts(sent, good).first()
    assert row["passed"] and row["benign_as_udpflood"] == 1 and row["attack_accuracy"] == 1.0
    collapsed = evaluate.smoke_verdicts(sent, good.limit(0)).first()
    assert not collapsed["passed"] and collapsed["returned"] == 0


def test_lookup_beyond_the_bound_gives_the_same_rows(spark):
    big = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("z", 4)], "k string, v int")
    small = spark.createDataFrame([("a", 10), ("b", 20), (None, 30)], "k string, w int")
    near = sorted(map(str, lookup.lookup_join(big, small, ["k"]).collect()))
    far = sorted(map(str, lookup.lookup_join(big, small, ["k"], max_rows=1).collect()))
    assert near == far and "w=30" in str(near)
    assert lookup.bounded(small, 2) is None and lookup.bounded(small, 3).count() == 3


def test_predictions_take_scoring_time_without_flow_time(spark):
    from pyspark.sql import functions as F

    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    flows = spark.createDataFrame([("1", None), ("2", "x")], "event_id string, t string").select(
        "event_id", F.when(F.col("t") == "x", F.to_timestamp(F.lit("2024-01-01 00:00:00"))).alias("ingestion_timestamp")
    )
    predictions = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C")], "event_id string, predicted_class string")
    found = {r["event_id"]: r["flow_timestamp"].month for r in lookup.join_predictions(predictions, flows, now).collect()}
    assert found == {"1": 2, "2": 1, "3": 2}
    assert lookup.without_prediction(flows, predictions).count() == 0
