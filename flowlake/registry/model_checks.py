"""Features, weights, training, scoring, evaluation and explanation."""

from pyspark.sql import functions as F

from flowlake import contract
from flowlake.operators import evaluate, explain, features, sampling, score, train
from flowlake.plans import kpi
from flowlake.registry.core import CLASSES, SCORED_SQL, flows_of, on_flows, query, rounded
from flowlake.session import materialize

LEVELS = {
    "Proto": ["icmp", "tcp", "udp"],
    "Cause": ["Shutdown", "Start", "Status"],
    "State": ["CON", "ECO", "FIN", "INT", "RST"],
    "sDSb": ["af11", "cs0", "cs6", "ef"],
    "dDSb": ["cs0", "cs6"],
}
HEAD = [*contract.NUMERIC, *contract.INDICATORS]

PAIR = ("Benign", "UDPFlood")


# ---- features ----------------------------------------------------------------


@query(
    "m1_indicators",
    on_flows("""SELECT event_id, CASE WHEN "Proto" = 'tcp' THEN 1 ELSE 0 END AS is_tcp,
      CASE WHEN "dTtl" IS NOT NULL THEN 1 ELSE 0 END AS has_dst_reply FROM flows"""),
)
def _(t):
    raw = t.flows.drop("is_tcp", "has_dst_reply")
    return features.add_indicators(raw).select("event_id", "is_tcp", "has_dst_reply")


@query(
    "m2_sentinel_fill",
    on_flows("SELECT event_id, " + ", ".join(f'coalesce("{c}", -1) AS "{c}"' for c in ("dTtl", "SrcWin", "sTos", "TotPkts")) + ', "sDSb" FROM flows'),
)
def _(t):
    return features.fill_sentinel(t.flows).select("event_id", "dTtl", "SrcWin", "sTos", "TotPkts", "sDSb")


def _dummies_sql() -> list[str]:
    return [
        f"""CASE WHEN "{c}" = '{v}' THEN 1.0::double ELSE 0.0::double END AS "{c}_{v}" """ for c, vs in LEVELS.items() for v in vs
    ]


@query("m3_one_hot", on_flows("SELECT event_id, " + ", ".join(_dummies_sql()) + " FROM flows"))
def _(t):
    levels = features.vocabulary(t.flows)
    return t.flows.select("event_id", *[c.alias(name) for name, c in features.one_hot(levels).items()])


def _engineered_sql(digits: int = 9) -> list[str]:
    texts = {
        "bytes_per_packet": '"TotBytes" / ("TotPkts" + 1)',
        "src_dst_pkt_ratio": '"SrcPkts" / ("DstPkts" + 1)',
        "src_dst_byte_ratio": '"SrcBytes" / ("DstBytes" + 1)',
        "log_rate": 'ln(1 + greatest("Rate", 0))',
        "log_totbytes": 'ln(1 + greatest("TotBytes", 0))',
        "log_totpkts": 'ln(1 + greatest("TotPkts", 0))',
    }
    return [f"round({text}, {digits}) AS {name}" for name, text in texts.items()]


@query("m4_engineered_features", on_flows("SELECT event_id, " + ", ".join(_engineered_sql()) + " FROM flows"))
def _(t):
    return rounded(features.add_engineered(t.flows).select("event_id", *features.ENGINEERED), 9)


@query(
    "m5_model_matrix",
    on_flows(
        "SELECT event_id, " + ", ".join([f'round(CAST(coalesce("{c}", -1) AS double), 9) AS "{c}"' for c in HEAD] + _dummies_sql() + _engineered_sql())
        + " FROM flows"
    ),
)
def _(t):
    encoder = features.FlowEncoder.fit(t.flows, engineer=True)
    return rounded(encoder.transform(t.flows, ["event_id"]), 9)


@query(
    "p8_align_to_training",
    on_flows("""SELECT event_id, CAST("TotPkts" AS double) AS "TotPkts", 0.0::double AS "Rate", 0.0::double AS is_tcp,
      CASE WHEN "Proto" = 'udp' THEN 1.0::double ELSE 0.0::double END AS "Proto_udp", 0.0::double AS "Cause_Start"
      FROM flows"""),
)
def _(t):
    # The batch lacks Rate and Cause, and has a column that training never saw.
    batch = t.flows.select("event_id", "TotPkts", F.upper("Proto").alias("extra"), F.col("Proto").alias("kept"))
    made = {"TotPkts": F.col("TotPkts"), "Proto_udp": F.when(F.col("kept") == "udp", 1.0).otherwise(0.0)}
    return batch.select(
        "event_id", *features.align(["TotPkts", "Rate", "is_tcp", "Proto_udp", "Cause_Start"], made)
    )


@query(
    "m6_label_encoding",
    on_flows("""SELECT event_id, CAST(dense_rank() OVER (ORDER BY attack_type) - 1 AS double) AS label_index, attack_type AS decoded FROM flows"""),
)
def _(t):
    classes = train.label_classes(t.flows, "attack_type")
    encoded = train.encode_label(t.flows, "attack_type", classes)
    return encoded.select("event_id", "label_index", train.decode_label(F.col("label_index"), classes).alias("decoded"))


@query(
    "m7_balanced_weights",
    on_flows("""SELECT event_id, round((SELECT count(*) FROM flows) / ((SELECT count(DISTINCT attack_type) FROM flows) * n), 6) AS weight
      FROM flows JOIN (SELECT attack_type, count(*) AS n FROM flows GROUP BY 1) USING (attack_type)"""),
)
def _(t):
    return rounded(train.with_balanced_weight(t.flows, "attack_type").select("event_id", "weight"))


@query(
    "m8_manual_weights",
    on_flows("SELECT attack_type, round(sum(CASE attack_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in train.MANUAL_WEIGHTS.items())
             + " END)::double, 6) AS total FROM flows GROUP BY 1"),
)
def _(t):
    weighted = train.with_manual_weight(t.flows.select("attack_type"), "attack_type")
    return rounded(weighted.groupBy("attack_type").agg(F.sum("weight").alias("total")))


@query(
    "m9_standard_scaling",
    on_flows("""SELECT event_id, round(("Dur" - (SELECT avg("Dur") FROM flows)) / (SELECT stddev_samp("Dur") FROM flows), 6) AS dur,
      round(("TotPkts" - (SELECT avg("TotPkts") FROM flows)) / (SELECT stddev_samp("TotPkts") FROM flows), 6) AS packets FROM flows"""),
)
def _(t):
    from pyspark.ml import functions as MF
    from pyspark.ml.feature import StandardScaler

    vectors = t.flows.select("event_id", train.feature_vector(["Dur", "TotPkts"]).alias("features"))
    fitted = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(vectors)
    values = train.scale(fitted, vectors).withColumn("v", MF.vector_to_array("features"))
    return rounded(values.select("event_id", F.get("v", F.lit(0)).alias("dur"), F.get("v", F.lit(1)).alias("packets")))


# ---- training ----------------------------------------------------------------


def _encoder(t):
    return t.kept("encoder", lambda: features.FlowEncoder.fit(t.flows))


def _split(t):
    """Model matrix with its split, stored once for all models of a session."""

    def make():
        # Rows are dealt evenly, however few parts the file has, and split before they become wide.
        cores = t.spark.sparkContext.defaultParallelism
        flows = flows_of(t.spark, t.events.repartition(4 * cores))
        marked = sampling.stratified_split(flows, "attack_type", "event_id")
        matrix = _encoder(t).transform(marked, ["event_id", "ingestion_timestamp", "attack_type", "split"])
        return materialize(matrix.select(*[F.col(f"`{c}`") for c in matrix.columns if c != "split"], "split"), "split")

    return t.kept("split", make)


def _part(t, name):
    return _split(t).filter(F.col("split") == name)


def _weighted(t):
    return train.with_balanced_weight(_part(t, "train"), "attack_type")


def _logistic(t):
    return t.kept(
        "logistic",
        lambda: train.fit_logistic(_weighted(t), _encoder(t).columns, "attack_type", encoder=_encoder(t)),
    )


def _forest(t):
    return t.kept(
        "forest",
        lambda: train.fit_forest(_weighted(t), _encoder(t).columns, "attack_type", encoder=_encoder(t)),
    )


def _malicious(t):
    return t.kept("malicious", lambda: train.fit_malicious(_part(t, "train"), _encoder(t).columns))


def _boosted(t):
    return t.kept("boosted", lambda: train.fit_boosted(_weighted(t), _encoder(t).columns, "attack_type"))


def _manual(t):
    def make():
        weighted = train.with_manual_weight(_part(t, "train"), "attack_type")
        return train.fit_boosted(weighted, _encoder(t).columns, "attack_type")

    return t.kept("manual", make)


def _specialist(t):
    return t.kept("specialist", lambda: train.fit_specialist(_part(t, "train"), _encoder(t).columns, pair=PAIR))


def _report(t, model, label="attack_type", part="val"):
    return evaluate.class_report(score.score_matrix(_part(t, part), model), label, "predicted_class")


@query("m10_logistic_regression")
def _(t):
    return _report(t, _logistic(t))


@query("p10_logistic_without_fingerprint")
def _(t):
    columns = train.without_fingerprint(_encoder(t).columns)
    return _report(t, train.fit_logistic(_weighted(t), columns, "attack_type", iterations=5000))


@query("m11_random_forest")
def _(t):
    return _report(t, _forest(t))


@query("m12_boosted_classes")
def _(t):
    return _report(t, _boosted(t))


@query("m13_boosted_malicious")
def _(t):
    scored = score.score_matrix(_part(t, "val"), _malicious(t)).withColumns(
        {
            "truth": (F.col("attack_type") != "Benign").cast("int"),
            "guess": (F.col("predicted_class") == "Malicious").cast("int"),
            "p": F.get("probabilities", F.lit(1)),
        }
    )
    return evaluate.binary_report(scored, "truth", "guess", "p")


@query("m14_specialist_probe")
def _(t):
    scored = score.score_matrix(train.class_subset(_part(t, "val"), "attack_type", PAIR), _specialist(t)).withColumns(
        {
            "truth": (F.col("attack_type") == PAIR[1]).cast("int"),
            "guess": (F.col("predicted_class") == PAIR[1]).cast("int"),
            "p": F.get("probabilities", F.lit(1)),
        }
    )
    return evaluate.binary_report(scored, "truth", "guess", "p")


@query("m15_boosted_manual_weights")
def _(t):
    return _report(t, _manual(t))


@query("m16_batch_scoring")
def _(t):
    scored = score.score_flows(t.flows, _logistic(t))
    return scored.select(
        "event_id", "predicted_class", "probability", F.col("all_probabilities")["Benign"].alias("p_benign"),
        "model_version", "schema_version",
    )


@query("m16_prediction_table")
def _(t):
    predictions = score.as_predictions(score.score_flows(t.flows, _forest(t)))
    return score.stored(predictions, score.PREDICTIONS_SCHEMA)


@query("m20_feature_importance")
def _(t):
    return train.feature_importance(_forest(t), t.spark, 20)


@query("m20_coefficient_importance")
def _(t):
    return train.feature_importance(_logistic(t), t.spark, 20)


# ---- explanation -------------------------------------------------------------


@query("m21_linear_contributions")
def _(t):
    test = _part(t, "test").select("event_id", *[f"`{c}`" for c in _encoder(t).columns])
    found = explain.linear_contributions(test, _logistic(t))
    return _long(found, _logistic(t))


@query("m21_forest_contributions")
def _(t):
    test = _part(t, "test").select("event_id", *[f"`{c}`" for c in _encoder(t).columns])
    return _long(explain.forest_contributions(test, _forest(t), ["event_id"]), _forest(t))


@query("m21_boosted_contributions")
def _(t):
    test = _part(t, "test").select("event_id", *[f"`{c}`" for c in _encoder(t).columns])
    return _long(explain.forest_contributions(test, _boosted(t), ["event_id"]), _boosted(t))


def _long(found, model):
    """The contribution of every feature to the sum, as one total per row and class."""
    names = F.array(*[F.lit(c) for c in model.classes])
    each = found.select("event_id", F.posexplode("contributions").alias("i", "parts"))
    return each.select(
        "event_id", F.get(names, F.col("i")).alias("class"),
        F.aggregate("parts", F.lit(0.0), lambda a, x: a + x).alias("total_contribution"),
    )


@query("m22_global_importance")
def _(t):
    return explain.global_importance(_part(t, "test"), _boosted(t))


@query("m22_linear_importance")
def _(t):
    return explain.global_importance(_part(t, "test"), _logistic(t))


@query("m23_local_explanation")
def _(t):
    scored = score.score_matrix(_part(t, "test"), _boosted(t))
    found = explain.explain_rows(scored, _boosted(t), ["event_id"])
    return found.select("event_id", "predicted_class", "probability", F.inline("top_features"))


@query("b10_model_card")
def _(t):
    scored = score.score_matrix(_part(t, "test"), _logistic(t))
    return kpi.model_card(evaluate.model_performance(scored, "attack_type", "predicted_class", "1"))


# ---- evaluation of the fixed rule --------------------------------------------

REPORT = SCORED_SQL + """, pairs AS (SELECT attack_type AS l, predicted_class AS p, count(*) AS n FROM scored GROUP BY 1, 2),
  classes AS (SELECT l AS class FROM pairs UNION SELECT p FROM pairs),
  counts AS (SELECT class, coalesce((SELECT sum(n) FROM pairs WHERE l = class AND p = class), 0) AS hits,
    coalesce((SELECT sum(n) FROM pairs WHERE l = class), 0) AS support,
    coalesce((SELECT sum(n) FROM pairs WHERE p = class), 0) AS predicted FROM classes),
  scores AS (SELECT class, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision_score,
    CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall_score,
    CASE WHEN support + predicted > 0 THEN 2.0::double * hits / (support + predicted) ELSE 0 END AS f1_score,
    support, hits FROM counts),
  report AS (SELECT class, round(precision_score, 6) AS precision_score, round(recall_score, 6) AS recall_score,
    round(f1_score, 6) AS f1_score, CAST(support AS bigint) AS support, round(sum(hits) OVER () / sum(support) OVER (), 6) AS accuracy,
    round(avg(f1_score) OVER (), 6) AS macro_f1, round(sum(f1_score * support) OVER () / sum(support) OVER (), 6) AS weighted_f1 FROM scores)
"""


@query("m18_class_report", on_flows(REPORT + "SELECT * FROM report"))
def _(t):
    return rounded(evaluate.class_report(t.scored, "attack_type", "predicted_class"))


@query(
    "m18_model_performance",
    on_flows(REPORT + "SELECT 'rule-1' AS model_version, * FROM report"),
)
def _(t):
    found = evaluate.model_performance(t.scored, "attack_type", "predicted_class", "rule-1")
    return rounded(found.drop("evaluated_at"))


def _probabilities(t):
    """Class probabilities that agree with the fixed rule: the second class gets most of the rest."""
    second = F.when(F.col("predicted_class") == "Benign", "UDPFlood").otherwise("Benign")
    p, rest = F.col("probability"), F.lit(1.0) - F.col("probability")
    cells = [
        F.when(F.col("predicted_class") == c, p).when(second == c, rest * 0.6).otherwise(rest * 0.4 / 7) for c in CLASSES
    ]
    return t.scored.withColumn("probabilities", F.array(*cells))


SWEEP = SCORED_SQL + """, steps AS (SELECT i, CAST(0.3 AS double) + i * CAST(0.05 AS double) AS t FROM range(14) AS r(i)),
  guesses AS (SELECT i, t, attack_type AS l,
    CASE WHEN predicted_class = 'UDPFlood' AND probability <= t THEN 'Benign' ELSE predicted_class END AS p FROM scored, steps),
  pairs AS (SELECT i, t, l, p, count(*) AS n FROM guesses GROUP BY ALL),
  sides AS (SELECT i, t, l AS class, n AS support, 0 AS predicted, CASE WHEN l = p THEN n ELSE 0 END AS hits FROM pairs
    UNION ALL SELECT i, t, p, 0, n, 0 FROM pairs),
  classes AS (SELECT i, t, class, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits FROM sides GROUP BY ALL)
  SELECT round(t, 2) AS threshold,
    round(coalesce(max(hits / support) FILTER (class = 'Benign'), 0), 6) AS benign_recall,
    round(coalesce(max(hits / support) FILTER (class = 'UDPFlood'), 0), 6) AS udpflood_recall,
    round(avg(2.0::double * hits / (support + predicted)), 6) AS macro_f1 FROM classes GROUP BY i, t
"""


@query("m17_threshold_sweep", on_flows(SWEEP))
def _(t):
    return rounded(evaluate.threshold_sweep(_probabilities(t), "attack_type", "probabilities", CLASSES))


BINARY = SCORED_SQL + """, sides AS (SELECT CASE WHEN attack_type <> 'Benign' THEN 1 ELSE 0 END AS t,
    CASE WHEN predicted_class <> 'Benign' THEN 1 ELSE 0 END AS g,
    CASE WHEN predicted_class <> 'Benign' THEN probability ELSE 1 - probability END AS p FROM scored),
  counts AS (SELECT count(*) FILTER (t = 1 AND g = 1) AS tp, count(*) FILTER (t = 0 AND g = 1) AS fp,
    count(*) FILTER (t = 1 AND g = 0) AS fn, count(*) FILTER (t = 0 AND g = 0) AS tn FROM sides),
  ranks AS (SELECT t, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM sides),
  area AS (SELECT (sum(r) FILTER (t = 1) - count(*) FILTER (t = 1) * (count(*) FILTER (t = 1) + 1) / 2.0)
    / (count(*) FILTER (t = 1) * count(*) FILTER (t = 0)) AS a FROM ranks)
  SELECT 'accuracy' AS metric, round((tp + tn) / (tp + fp + fn + tn), 6) AS value FROM counts
  UNION ALL SELECT 'f1_binary', round(2.0::double * tp / (2 * tp + fp + fn), 6) FROM counts
  UNION ALL SELECT 'precision_malicious', round(tp / (tp + fp), 6) FROM counts
  UNION ALL SELECT 'recall_malicious', round(tp / (tp + fn), 6) FROM counts
  UNION ALL SELECT 'precision_benign', round(tn / (tn + fn), 6) FROM counts
  UNION ALL SELECT 'recall_benign', round(tn / (tn + fp), 6) FROM counts
  UNION ALL SELECT 'roc_auc', round(a::double, 6) FROM area
"""


@query("m19_binary_metrics", on_flows(BINARY))
def _(t):
    sides = t.scored.select(
        (F.col("attack_type") != "Benign").cast("int").alias("truth"),
        (F.col("predicted_class") != "Benign").cast("int").alias("guess"),
        F.when(F.col("predicted_class") != "Benign", F.col("probability")).otherwise(1 - F.col("probability")).alias("p"),
    )
    return rounded(evaluate.binary_report(sides, "truth", "guess", "p"))


@query(
    "m19_label_area",
    """WITH sides AS (SELECT quality AS t, n_chars AS p FROM labels JOIN documents USING (doc_id)),
      ranks AS (SELECT t, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM sides)
      SELECT round(CAST((sum(r) FILTER (t = 1) - count(*) FILTER (t = 1) * (count(*) FILTER (t = 1) + 1) / 2.0)
        / (count(*) FILTER (t = 1) * count(*) FILTER (t = 0)) AS double), 6) AS roc_auc FROM ranks""",
)
def _(t):
    joined = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return rounded(evaluate.roc_auc(joined, "quality", "n_chars"))


@query(
    "m30_smoke_verdicts",
    on_flows(SCORED_SQL + """, one AS (SELECT count(*) AS sent, count(predicted_class) AS returned, count(DISTINCT predicted_class) AS classes,
        avg(CASE WHEN attack_type = predicted_class THEN 1 ELSE 0 END) FILTER (attack_type <> 'Benign') AS acc,
        count(*) FILTER (attack_type = 'Benign' AND predicted_class = 'UDPFlood') AS benign_as_udpflood FROM scored)
      SELECT sent, returned, CAST(0 AS bigint) AS repeated, CAST(0 AS bigint) AS unknown, sent = returned AS all_returned, classes, classes > 1 AS varied, round(acc, 6) AS attack_accuracy,
        acc >= 0.8 AS accurate, benign_as_udpflood, sent = returned AND classes > 1 AND acc >= 0.8 AS passed FROM one"""),
)
def _(t):
    return rounded(evaluate.smoke_verdicts(t.flows, t.scored.select("event_id", "predicted_class")))


@query(
    "m30_repeated_and_missing",
    on_flows("""SELECT sum(CASE WHEN row_id % 10 <> 3 THEN 1 ELSE 0 END)::bigint AS returned, count(*) AS sent,
        sum(CASE WHEN row_id % 10 = 1 THEN 1 ELSE 0 END)::bigint AS repeated, CAST(1 AS bigint) AS unknown, false AS all_returned, false AS passed
      FROM flows"""),
)
def _(t):
    """Some predictions come twice, some not at all, one for an id that was never sent."""
    scored = t.scored.filter("row_id % 10 <> 3").select("event_id", "predicted_class", "row_id")
    twice = scored.unionByName(scored.filter("row_id % 10 = 1")).drop("row_id")
    other = t.spark.sql("SELECT 'evt_other' AS event_id, 'Benign' AS predicted_class")
    found = evaluate.smoke_verdicts(t.flows, twice.unionByName(other))
    return found.select("sent", "returned", "repeated", "unknown", "all_returned", "passed")


# ---- the multiclass table ----------------------------------------------------


@query("m10_embedding_classes")
def _(t):
    names = [f"e{i}" for i in range(64)]
    rows = t.embeddings.select(
        F.col("vec_id").cast("string").alias("event_id"), F.concat(F.lit("c"), F.col("label").cast("string")).alias("kind"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)],
    )
    split = materialize(sampling.stratified_split(rows, "kind", "event_id"), "embedding-split")
    model = train.fit_logistic(
        train.with_balanced_weight(split.filter("split = 'train'"), "kind"), names, "kind"
    )
    return evaluate.class_report(score.score_matrix(split.filter("split <> 'train'"), model), "kind", "predicted_class")


# ---- ranking of contributions ------------------------------------------------

# A fixed linear score stands in for a model: weight times value, per class.
PARTS = {"Dur": 0.5, "Rate": -2.0, "sHops": 1.25, "TotPkts": 0.03, "sMeanPktSz": -0.02, "pLoss": 40.0, "TcpRtt": 75.0}
PARTS_SQL = ", parts AS (" + " UNION ALL ".join(
    f"""SELECT event_id, attack_type AS class, '{c}' AS feature, CAST("{c}" AS double) AS value, "{c}" * {w}::double AS contribution FROM flows"""
    for c, w in PARTS.items()
) + ")"


@query(
    "a18_mean_contributions",
    on_flows(PARTS_SQL + """, means AS (SELECT class, feature, avg(abs(contribution)) AS v FROM parts GROUP BY 1, 2),
      both_ AS (SELECT * FROM means UNION ALL SELECT 'Overall', feature, avg(v) FROM means GROUP BY 2)
      SELECT '1' AS model_version, class, feature, round(v, 6) AS mean_abs_shap,
        row_number() OVER (PARTITION BY class ORDER BY v DESC, feature) AS feature_rank FROM both_"""),
)
def _(t):
    means = [F.avg(F.abs(F.col(c) * w)).alias(c) for c, w in PARTS.items()]
    wide = t.flows.groupBy(F.col("attack_type").alias("class")).agg(*means)
    long = wide.unpivot("class", list(PARTS), "feature", "mean_abs_shap")
    return rounded(explain.importance_table(long, "1"))


@query(
    "w6_importance_rank",
    on_flows(PARTS_SQL + """, means AS (SELECT class, feature, avg(abs(contribution)) AS v FROM parts GROUP BY 1, 2)
      SELECT class, feature, row_number() OVER (PARTITION BY class ORDER BY v DESC, feature) AS feature_rank FROM means
      QUALIFY feature_rank <= 3"""),
)
def _(t):
    means = [F.avg(F.abs(F.col(c) * w)).alias(c) for c, w in PARTS.items()]
    wide = t.flows.groupBy(F.col("attack_type").alias("class")).agg(*means)
    ranked = explain.importance_table(wide.unpivot("class", list(PARTS), "feature", "mean_abs_shap"), "1")
    return ranked.filter("class <> 'Overall' AND feature_rank <= 3").select("class", "feature", "feature_rank")


@query(
    "w7_top_features_per_row",
    on_flows(PARTS_SQL + """SELECT event_id, feature, round(value, 6) AS value, round(contribution, 6) AS shap_contribution FROM parts
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY abs(contribution) DESC, feature) <= 5"""),
)
def _(t):
    names = sorted(PARTS)
    row = F.array(*[F.col(c).cast("double") for c in names])
    parts = F.array(*[F.col(c) * PARTS[c] for c in names])
    top = explain.top_features(row, parts, names)
    return rounded(t.flows.select("event_id", F.inline(top)))


@query(
    "b8_top_features",
    on_flows(PARTS_SQL + """, means AS (SELECT class, feature, avg(abs(contribution)) AS v FROM parts GROUP BY 1, 2),
      overall AS (SELECT feature, avg(v) AS v FROM means GROUP BY 1)
      SELECT '1' AS model_version, 'Overall' AS class, feature, round(v, 6) AS mean_abs_shap, row_number() OVER (ORDER BY v DESC, feature) AS feature_rank
      FROM overall QUALIFY feature_rank <= 5"""),
)
def _(t):
    means = [F.avg(F.abs(F.col(c) * w)).alias(c) for c, w in PARTS.items()]
    wide = t.flows.groupBy(F.col("attack_type").alias("class")).agg(*means)
    ranked = explain.importance_table(wide.unpivot("class", list(PARTS), "feature", "mean_abs_shap"), "1")
    return rounded(kpi.top_importance(ranked, 5))


@query("b8_top_features_of_model")
def _(t):
    return kpi.top_importance(explain.global_importance(_part(t, "test"), _logistic(t)), 10)
