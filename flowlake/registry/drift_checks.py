"""Drift of the second half of the month against the first."""


from flowlake.operators import drift
from flowlake.plans import kpi
from flowlake.registry.core import SCORED_SQL, on_flows, query, rounded

COLUMNS = ["Dur", "Rate", "TotPkts", "TotBytes", "sHops", "dTtl", "SrcWin", "DstLoss", "is_tcp"]
CATEGORIES = ["Proto", "Cause", "State", "sDSb", "dDSb"]
SHIFTED = ["Dur", "Rate", "TotPkts", "TotBytes", "sHops"]


def _long(columns: list[str], reference: str, current: str) -> str:
    part = """SELECT '{c}' AS feature, CAST("{c}" AS double) AS value, {r} AS is_ref FROM {s} WHERE "{c}" IS NOT NULL"""
    return " UNION ALL ".join(
        part.format(c=c, r=flag, s=source) for c in columns for flag, source in (("true", reference), ("false", current))
    )


SIDES = """, ref AS (SELECT * FROM flows WHERE ingestion_timestamp < TIMESTAMP '2024-01-15'),
  cur AS (SELECT * FROM flows WHERE ingestion_timestamp >= TIMESTAMP '2024-01-15')
"""


def _drift_sql(columns: list[str], current: str = "cur") -> str:
    return f""", long AS ({_long(columns, "ref", current)}),
  sizes AS (SELECT feature, count(*) FILTER (is_ref) AS n, count(*) FILTER (NOT is_ref) AS m FROM long GROUP BY 1),
  edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e
    FROM long WHERE is_ref GROUP BY 1),
  binned AS (SELECT feature, is_ref, least(len(list_filter(e, lambda x: x <= value)), len(e) - 1) AS b
    FROM long JOIN edges USING (feature) WHERE len(e) >= 3 AND value >= e[1] AND value <= e[-1]),
  bins AS (SELECT feature, b, count(*) FILTER (is_ref) / max(n) + 1e-6 AS r, count(*) FILTER (NOT is_ref) / max(m) + 1e-6 AS c
    FROM binned JOIN sizes USING (feature) GROUP BY 1, 2),
  psis AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM bins GROUP BY 1),
  counted AS (SELECT feature, value, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM long GROUP BY 1, 2),
  cdfs AS (SELECT feature, abs(sum(r) OVER w / n - sum(c) OVER w / m) AS gap FROM counted JOIN sizes USING (feature)
    WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
  ks AS (SELECT feature, max(gap) AS d FROM cdfs GROUP BY 1),
  tested AS (SELECT feature, coalesce(psi, 0) AS psi, d, n, m, CASE WHEN coalesce(psi, 0) > 0.2 THEN 1 ELSE 0 END AS drifted
    FROM sizes JOIN ks USING (feature) LEFT JOIN psis USING (feature)),
  steps AS (SELECT feature, value, abs(sum(r) OVER w / n - sum(c) OVER w / m) AS gap, lead(value) OVER (PARTITION BY feature ORDER BY value) AS next
    FROM counted JOIN sizes USING (feature) WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
  areas AS (SELECT feature, sum(gap * (next - value)) AS area FROM steps GROUP BY 1),
  spreads AS (SELECT feature, greatest(stddev_pop(value), 0.001) AS s FROM long WHERE is_ref GROUP BY 1),
  transport AS (SELECT feature, coalesce(area, 0) / s AS w FROM areas JOIN spreads USING (feature)),
  drift AS (SELECT feature, round(psi, 6) AS psi, round(d, 6) AS ks_statistic,
    CASE WHEN sqrt(n * m / (n + m)) * d < 0.2 THEN 1.0::double ELSE least(1, greatest(0, list_sum(list_transform(range(1, 101),
      lambda j: CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * pow(sqrt(n * m / (n + m)) * d, 2)))))) END AS ks_p_value,
    drifted, round(avg(drifted) OVER (), 4) AS share_drifted,
    CASE WHEN avg(drifted) OVER () > 0.5 THEN 1 ELSE 0 END AS dataset_drift_detected,
    (SELECT count(*) FROM ref) AS reference_size, (SELECT count(*) FROM {current}) AS current_size FROM tested)
"""


DRIFT = SIDES + _drift_sql(COLUMNS)
SHIFT = SIDES + ", shift AS (SELECT * REPLACE (" + ", ".join(
    f'"{c}" + 2 * (SELECT stddev_samp("{c}") FROM cur) AS "{c}"' for c in SHIFTED
) + ") FROM cur)" + _drift_sql(SHIFTED, "shift")
PLAIN = """SELECT feature, psi, ks_statistic, round(ks_p_value, 6) AS ks_p_value, drifted, share_drifted,
  dataset_drift_detected, reference_size, current_size FROM drift"""


def _table(t):
    return drift.drift_table(t.reference, t.current, COLUMNS, exact_up_to=0)


@query("m27_drift_table", on_flows(DRIFT + PLAIN))
def _(t):
    return rounded(_table(t).drop("computed_at"))


@query("m25_psi", on_flows(DRIFT + "SELECT feature, round(coalesce(psi, 0), 6) AS psi FROM tested"))
def _(t):
    return rounded(drift.numeric_distances(t.reference, t.current, COLUMNS).select("feature", "psi"))


@query("m26_ks_statistic", on_flows(DRIFT + "SELECT feature, round(d, 6) AS ks_statistic, n, m FROM tested"))
def _(t):
    return rounded(drift.numeric_distances(t.reference, t.current, COLUMNS).select("feature", "ks_statistic", "n", "m"))


@query("m28_wasserstein", on_flows(DRIFT + "SELECT feature, round(w, 6) AS wasserstein FROM transport"))
def _(t):
    return rounded(drift.numeric_distances(t.reference, t.current, COLUMNS).select("feature", "wasserstein"))


@query("m29_shifted_batch_drifts", on_flows(SHIFT + PLAIN))
def _(t):
    moved = drift.shifted(t.current, SHIFTED)
    return rounded(drift.drift_table(t.reference, moved, SHIFTED, exact_up_to=0).drop("computed_at"))


@query(
    "m24_drift_reference",
    on_flows("""SELECT event_id, attack_type AS prediction FROM flows
      QUALIFY row_number() OVER (PARTITION BY attack_type ORDER BY md5(concat(event_id, '|42')), event_id) <= 5000"""),
)
def _(t):
    train = t.flows.select("event_id", "attack_type")
    return drift.reference_sample(train, "attack_type", "event_id").select("event_id", "prediction")


CATEGORY = SIDES + ", pairs AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, "{c}" AS value, {flag} AS is_ref FROM {source} WHERE "{c}" IS NOT NULL"""
    for c in CATEGORIES for flag, source in (("true", "ref"), ("false", "cur"))
) + """), levels AS (SELECT feature, value, CAST(count(*) FILTER (is_ref) AS double) AS r, CAST(count(*) FILTER (NOT is_ref) AS double) AS c
    FROM pairs GROUP BY 1, 2),
  totals AS (SELECT feature, sum(r) AS n, sum(c) AS m, count(*) AS k FROM levels GROUP BY 1),
  shares AS (SELECT *, r / n AS p, c / m AS q, (r + c) * n / (n + m) AS er, (r + c) * m / (n + m) AS ec FROM levels JOIN totals USING (feature)),
  distances AS (SELECT feature, CAST(max(n) AS bigint) AS n, CAST(max(m) AS bigint) AS m,
    sum((q + 1e-6 - p - 1e-6) * ln((q + 1e-6) / (p + 1e-6))) AS psi,
    sum((r - er) * (r - er) / er + (c - ec) * (c - ec) / ec) AS chi_square, max(k) - 1 AS degrees_of_freedom,
    sqrt(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2) AS js_distance
    FROM shares GROUP BY 1)
"""


@query(
    "m28_category_drift",
    on_flows(CATEGORY + """SELECT feature, n, m, round(psi, 6) AS psi, round(chi_square, 6) AS chi_square,
      CAST(degrees_of_freedom AS bigint) AS degrees_of_freedom, round(js_distance, 6) AS js_distance FROM distances"""),
)
def _(t):
    return rounded(drift.category_distances(t.reference, t.current, CATEGORIES).drop("p_value"))


@query(
    "m28_column_drift",
    on_flows(DRIFT + CATEGORY.removeprefix(SIDES) + """, judged AS (
      SELECT feature, 'numeric' AS kind, psi, w AS distance, CASE WHEN w > 0.1 THEN 1 ELSE 0 END AS drifted FROM tested JOIN transport USING (feature)
      UNION ALL SELECT feature, 'category', psi, js_distance, CASE WHEN js_distance > 0.1 THEN 1 ELSE 0 END FROM distances)
      SELECT feature, kind, round(psi, 6) AS psi, round(distance, 6) AS distance, drifted,
        round(avg(drifted) OVER (), 6) AS share_drifted, CASE WHEN avg(drifted) OVER () > 0.5 THEN 1 ELSE 0 END AS dataset_drift_detected
      FROM judged"""),
)
def _(t):
    return rounded(drift.column_drift(t.reference, t.current, COLUMNS + CATEGORIES))


@query(
    "m28_prediction_drift",
    on_flows(SCORED_SQL + """, pairs AS (SELECT predicted_class AS v, ingestion_timestamp < TIMESTAMP '2024-01-15' AS is_ref FROM scored),
      levels AS (SELECT v, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM pairs GROUP BY 1),
      shares AS (SELECT r / sum(r) OVER () + 1e-6 AS p, c / sum(c) OVER () + 1e-6 AS q FROM levels)
      SELECT 'predicted_class' AS feature, round(sum((q - p) * ln(q / p)), 6) AS psi FROM shares"""),
)
def _(t):
    from flowlake.registry.core import add_rule_score

    found = drift.category_distances(add_rule_score(t.reference), add_rule_score(t.current), ["predicted_class"])
    return rounded(found.select("feature", "psi"))


@query(
    "b9_drift_verdict",
    on_flows(DRIFT + """SELECT count(*) AS features, CAST(sum(drifted) AS bigint) AS drifted_features, max(share_drifted) AS share_drifted,
      max(dataset_drift_detected) AS dataset_drift_detected FROM drift"""),
)
def _(t):
    return kpi.drift_verdict(_table(t))


@query(
    "b9_top_drift",
    on_flows(DRIFT + "SELECT feature, psi, ks_statistic, drifted FROM drift ORDER BY psi DESC, feature LIMIT 5"),
)
def _(t):
    return rounded(kpi.top_drift(_table(t)))


