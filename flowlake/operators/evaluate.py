"""Model quality from (label, prediction) rows.

Everything starts from counts per (label, prediction), a table as small as the
number of class pairs, so the rows are read once and only partial counts move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.operators.ordered import running_totals, value_table

# Start, step and number of the thresholds that are tried.
THRESHOLDS = [0.30 + i * 0.05 for i in range(14)]


def pair_counts(scored: DataFrame, label: str, prediction: str, *groups: str) -> DataFrame:
    return scored.groupBy(
        *groups, F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame, label: str, prediction: str, classes: list[str]) -> DataFrame:
    """One row per label, one column per predicted class."""
    counts = pair_counts(scored, label, prediction)
    return counts.groupBy("label").pivot("prediction", classes).agg(F.sum("n")).na.fill(0, classes)


def report_from_pairs(pairs: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Per-class precision, recall, F1 and support with the overall figures on every row.

    A class without predictions or without rows scores 0 instead of failing.
    """
    groups = list(groups or [])
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    per_class = (
        pairs.select(*groups, F.inline(sides)).groupBy(*groups, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .filter("support > 0 OR predicted > 0")
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    scored = per_class.withColumns(
        {
            "precision_score": share(hits, predicted),
            "recall_score": share(hits, support),
            "f1_score": share(F.lit(2.0) * hits, support + predicted),
        }
    )
    everything = Window.partitionBy(*groups)
    total = F.sum("support").over(everything)
    return scored.select(
        *groups, "class", "precision_score", "recall_score", "f1_score", "support",
        (F.sum("hits").over(everything) / total).alias("accuracy"),
        F.avg("f1_score").over(everything).alias("macro_f1"),
        (F.sum(F.col("f1_score") * support).over(everything) / total).alias("weighted_f1"),
    )


def class_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return report_from_pairs(pair_counts(scored, label, prediction))


def model_performance(scored: DataFrame, label: str, prediction: str, version: str) -> DataFrame:
    """The stored performance table."""
    return class_report(scored, label, prediction).select(
        F.lit(version).alias("model_version"), "class", "precision_score", "recall_score", "f1_score",
        "support", "accuracy", "macro_f1", "weighted_f1", F.current_timestamp().alias("evaluated_at"),
    )


def top_two(probabilities: Column, classes: list[str]) -> tuple[Column, Column]:
    """Names of the most and second most probable class; ties go to the earlier class."""
    ranked = F.array_sort(
        F.transform(probabilities, lambda p, i: F.struct((-p).alias("p"), i.alias("i")))
    )
    names = F.array(*[F.lit(c) for c in classes])
    return F.get(names, F.get(ranked, F.lit(0))["i"]), F.get(names, F.get(ranked, F.lit(1))["i"])


def threshold_sweep(
    scored: DataFrame,
    label: str,
    probabilities: str,
    classes: list[str],
    target: str = "UDPFlood",
    watched: str = "Benign",
    thresholds: list[float] | None = None,
) -> DataFrame:
    """Recall and macro-F1 when ``target`` needs a probability above each threshold.

    Otherwise the second most probable class is taken. Rows are counted per
    (label, first, second, number of thresholds passed); the thresholds then
    meet those counts and not the rows.
    """
    thresholds = THRESHOLDS if thresholds is None else thresholds
    first, second = top_two(F.col(probabilities), classes)
    target_p = F.get(probabilities, F.lit(classes.index(target)))
    tried = F.array(*[F.lit(t) for t in thresholds])
    passed = F.size(F.filter(tried, lambda t: t < target_p))
    counts = (
        scored.select(F.col(label).alias("label"), first.alias("first"), second.alias("second"), passed.alias("passed"))
        .withColumn("passed", F.when(F.col("first") == target, F.col("passed")).otherwise(len(thresholds)))
        .groupBy("label", "first", "second", "passed").agg(F.count(F.lit(1)).alias("n"))
    )
    chosen = F.when(F.col("i") >= F.col("passed"), F.col("second")).otherwise(F.col("first"))
    pairs = (
        counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(thresholds) - 1))).alias("i"))
        .withColumn("prediction", chosen)
        .groupBy("i", "label", "prediction").agg(F.sum("n").alias("n"))
    )
    recall = lambda name: F.coalesce(F.max(F.when(F.col("class") == name, F.col("recall_score"))), F.lit(0.0))
    rounded = F.array(*[F.lit(round(t, 2)) for t in thresholds])
    return (
        report_from_pairs(pairs, ["i"]).groupBy("i")
        .agg(
            recall(watched).alias("benign_recall"), recall(target).alias("udpflood_recall"),
            F.max("macro_f1").alias("macro_f1"),
        )
        .select(F.get(rounded, F.col("i")).alias("threshold"), "benign_recall", "udpflood_recall", "macro_f1")
        .orderBy("threshold")
    )


def roc_auc(scored: DataFrame, truth: str, score: str) -> DataFrame:
    """Exact area under the ROC curve by rank sums; equal scores share their rank.

    ``truth`` is 0/1. Scores are counted per distinct value first.
    """
    positives, negatives = F.sum(F.col(truth)), F.sum(1 - F.col(truth))
    values = value_table(
        scored.select(F.col(truth).cast("bigint").alias(truth), score), score, {"pos": positives, "neg": negatives}
    )
    ordered = running_totals(values, score, {"below": "neg", "seen": "pos"})
    wins = F.sum(F.col("pos") * (F.col("below") - F.col("neg") * 0.5))
    pairs = F.max("seen_total") * F.max("below_total")
    return ordered.agg(F.when(pairs > 0, wins / pairs).alias("roc_auc"))


def binary_report(scored: DataFrame, truth: str, predicted: str, score: str) -> DataFrame:
    """Accuracy, F1, precision and recall of both sides and the ROC area, as metric rows."""
    t, p = F.col(truth), F.col(predicted)
    counts = scored.agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"), F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"), F.count_if((t == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    metrics = {
        "accuracy": share(tp + tn, tp + fp + fn + tn),
        "f1_binary": share(F.lit(2.0) * tp, 2 * tp + fp + fn),
        "precision_malicious": share(tp, tp + fp),
        "recall_malicious": share(tp, tp + fn),
        "precision_benign": share(tn, tn + fn),
        "recall_benign": share(tn, tn + fp),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in metrics.items()])
    area = roc_auc(scored, truth, score).select(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    return counts.select(F.inline(rows)).unionByName(area)


def smoke_verdicts(sent: DataFrame, predictions: DataFrame, truth: str = "attack_type") -> DataFrame:
    """Did scoring return every id once and no other, and do the answers vary and fit?

    Both sides are brought to one row per id before the join. ``repeated`` counts the
    predictions beyond one per id, ``unknown`` the predicted ids that were not sent.
    Benign rows are left out of the accuracy; how many were taken for UDPFlood is only
    reported.
    """
    asked = sent.groupBy("event_id").agg(F.min(truth).alias("truth"), F.lit(True).alias("asked"))
    answers = predictions.groupBy("event_id").agg(F.min("predicted_class").alias("guess"), F.count(F.lit(1)).alias("answers"))
    sides = asked.join(answers, "event_id", "full").groupBy("truth", "guess", "asked").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("answers") - 1).alias("beyond")
    )
    asked_for, answered = F.col("asked").isNotNull(), F.col("guess").isNotNull()
    attack = F.col("truth") != "Benign"
    n_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    one = sides.agg(
        n_if(asked_for).alias("sent"), n_if(asked_for & answered).alias("returned"),
        F.coalesce(F.sum("beyond"), F.lit(0)).alias("repeated"), n_if(~asked_for).alias("unknown"),
        F.count_distinct("guess").alias("classes"),
        n_if(attack).alias("attacks"), n_if(attack & (F.col("truth") == F.col("guess"))).alias("attack_hits"),
        n_if((F.col("truth") == "Benign") & (F.col("guess") == "UDPFlood")).alias("benign_as_udpflood"),
    )
    accuracy = F.when(F.col("attacks") > 0, F.col("attack_hits") / F.col("attacks")).otherwise(F.lit(1.0))
    complete = (F.col("sent") == F.col("returned")) & (F.col("repeated") == 0) & (F.col("unknown") == 0)
    return one.select(
        "sent", "returned", "repeated", "unknown", complete.alias("all_returned"),
        "classes", (F.col("classes") > 1).alias("varied"),
        accuracy.alias("attack_accuracy"), (accuracy >= 0.80).alias("accurate"), "benign_as_udpflood",
        (complete & (F.col("classes") > 1) & (accuracy >= 0.80)).alias("passed"),
    )
