"""Projections, filters, scalar functions, aggregates, windows, sampling and profiling."""

from pyspark.sql import functions as F

from flowlake import contract
from flowlake.functions import scalar
from flowlake.operators import drift, evaluate, ordered, profile, sampling, train
from flowlake.registry.core import SCORED_SQL, on_flows, plain_times, query, rounded

ORDER = "md5(concat(CAST({} AS varchar), '|42'))"


# ---- projections -------------------------------------------------------------


@query("p1_drop_contract_columns", on_flows('SELECT event_id, "Dur", "Proto", attack_type FROM flows'))
def _(t):
    raw = t.flows.withColumns({name: F.col("Dur") for name in ("RunTime", "Mean", "Sum", "Min", "Max")})
    return contract.drop_contract_columns(raw).select("event_id", "Dur", "Proto", "attack_type")


@query("p4_rename_labels", on_flows("SELECT event_id, attack_type, attack_tool FROM flows"))
def _(t):
    spaced = t.flows.select(
        "event_id", F.col("attack_type").alias("Attack Type"), F.col("attack_tool").alias("Attack Tool")
    )
    return contract.rename_labels(spaced)


@query(
    "p6_upper_case_columns",
    on_flows('SELECT event_id AS "EVENT_ID", "Dur" AS "DUR", attack_type AS "ATTACK_TYPE" FROM flows'),
)
def _(t):
    return contract.upper_columns(t.flows.select("event_id", "Dur", "attack_type"))


@query("p7_contract_case", on_flows('SELECT "Dur", "Proto", "sTtl", "TotBytes" FROM flows'))
def _(t):
    shouted = contract.upper_columns(t.flows.select("Dur", "Proto", "sTtl", "TotBytes"))
    return contract.contract_case(shouted)


@query(
    "p9_feature_columns",
    on_flows("SELECT " + ", ".join(f'"{n}"' for n in contract.FEATURE_NAMES) + ", is_tcp, has_dst_reply FROM flows"),
)
def _(t):
    flows = t.flows.drop("row_id", "Seq")
    return flows.select(contract.feature_columns(flows))


@query(
    "p11_common_columns",
    on_flows("SELECT count(*) AS n, CAST(sum(\"TotPkts\") AS bigint) AS packets, round(sum(\"sHops\"), 6) AS hops FROM flows"),
)
def _(t):
    left, right = t.reference.select("event_id", "TotPkts", "sHops", "Proto"), t.current.drop("Proto")
    names = contract.common_columns(left, right, numeric_only=True)
    both = left.select(names).unionByName(right.select(names))
    return rounded(both.agg(F.count(F.lit(1)).alias("n"), F.sum("TotPkts").alias("packets"), F.sum("sHops").alias("hops")))


@query(
    "p12_columns_by_type",
    "SELECT round(avg(l_quantity), 6) AS l_quantity, round(avg(l_discount), 6) AS l_discount FROM lineitem",
)
def _(t):
    frame = t.lineitem.select("l_quantity", "l_discount", "l_returnflag")
    return rounded(frame.agg(*[F.avg(c).alias(c) for c in contract.columns_of_kind(frame, "number")]))


# ---- filters, union, lookups -------------------------------------------------


@query("f2_class_subset", on_flows("SELECT event_id, attack_type FROM flows WHERE attack_type IN ('Benign', 'UDPFlood')"))
def _(t):
    return train.class_subset(t.flows, "attack_type", ("Benign", "UDPFlood")).select("event_id", "attack_type")


@query(
    "f3_non_null_statistic",
    on_flows("""SELECT feature, count(*) FILTER (day < 15 AND v IS NOT NULL) AS n, count(*) FILTER (day >= 15 AND v IS NOT NULL) AS m FROM (
      SELECT 'dTtl' AS feature, day(ingestion_timestamp) AS day, CAST("dTtl" AS double) AS v FROM flows
      UNION ALL SELECT 'sHops', day(ingestion_timestamp), CASE WHEN ingestion_timestamp < TIMESTAMP '2024-01-15' THEN "sHops" END FROM flows
      UNION ALL SELECT 'Rate', day(ingestion_timestamp), CASE WHEN ingestion_timestamp >= TIMESTAMP '2024-01-15' THEN "Rate" END FROM flows)
      GROUP BY 1 HAVING n > 0 AND m > 0"""),
)
def _(t):
    """Columns without values on one side have no distance."""
    from flowlake.operators import drift

    current = t.current.withColumn("sHops", F.lit(None).cast("double"))
    reference = t.reference.withColumn("Rate", F.lit(None).cast("double"))
    return drift.numeric_distances(reference, current, ["dTtl", "sHops", "Rate"]).select("feature", "n", "m")


@query(
    "u1_bag_union",
    on_flows("""SELECT attack_type, count(*) AS n FROM
      (SELECT * FROM flows UNION ALL SELECT * FROM flows WHERE attack_type <> 'Benign') GROUP BY 1"""),
)
def _(t):
    pick = t.flows.select("event_id", "attack_type")
    both = pick.unionByName(pick.filter("attack_type <> 'Benign'"))
    return both.groupBy("attack_type").agg(F.count(F.lit(1)).alias("n"))


WEIGHT_ROWS = ", ".join(f"('{k}', {v}::double)" for k, v in train.MANUAL_WEIGHTS.items())


@query(
    "j5_class_weight_lookup",
    on_flows(f"""SELECT event_id, w.weight FROM flows JOIN (VALUES {WEIGHT_ROWS}) AS w(c, weight) ON attack_type = c"""),
)
def _(t):
    return train.with_manual_weight(t.flows, "attack_type").select("event_id", "weight")


EDGES = [0.0, 5.0, 10.0, 20.0, 50.0, 100.0]


@query(
    "a15_histogram_on_edges",
    on_flows("""SELECT CASE WHEN "Dur" < 5 THEN 1 WHEN "Dur" < 10 THEN 2 WHEN "Dur" < 20 THEN 3 WHEN "Dur" < 50 THEN 4 ELSE 5 END AS bin,
      count(*) AS n FROM flows WHERE "Dur" BETWEEN 0 AND 100 GROUP BY 1"""),
)
def _(t):
    return profile.histogram(t.flows, "Dur", EDGES)


@query(
    "j6_total_on_rows",
    on_flows("""SELECT event_id, round("TotBytes" / (SELECT sum("TotBytes") FROM flows)::double * 1000, 6) AS per_mille FROM flows"""),
)
def _(t):
    total = t.flows.agg(F.sum("TotBytes").alias("s")).scalar()
    return rounded(t.flows.select("event_id", (F.col("TotBytes") / total * 1000).alias("per_mille")))


# ---- scalar functions --------------------------------------------------------


@query(
    "fn_event_id",
    on_flows("""SELECT row_id, concat('evt_', lpad(CAST(row_id AS varchar), 8, '0'), '_',
      substr(sha256(concat(schema_version, chr(31), "Proto")), 1, 24)) AS event_key FROM flows"""),
)
def _(t):
    return t.flows.select("row_id", scalar.event_id(F.col("schema_version"), F.col("Proto"), number=F.col("row_id")).alias("event_key"))


@query(
    "fn_json_safe",
    on_flows("""SELECT event_id, CASE WHEN "DstPkts" > 0 THEN round("Rate" / "DstPkts", 6) END AS rate_per_reply FROM flows"""),
)
def _(t):
    per_reply = t.flows.select("event_id", scalar.ratio(F.col("Rate"), F.col("DstPkts")).alias("x"))
    return rounded(per_reply.select("event_id", scalar.json_safe("x", per_reply.schema["x"].dataType).alias("rate_per_reply")))


@query(
    "fn_parse_timestamp",
    "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS parsed FROM events",
)
def _(t):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    broken = F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(text)
    return plain_times(t.events.select("event_id", F.try_to_timestamp(broken).alias("parsed")))


# ---- aggregates and profiling ------------------------------------------------


@query("a5_value_counts", on_flows("SELECT attack_type AS value, count(*) AS n FROM flows GROUP BY 1"))
def _(t):
    return profile.value_counts(t.flows, "attack_type")


NULLABLE = ["sTos", "dTos", "sDSb", "dDSb", "sTtl", "dTtl", "SrcWin", "DstWin", "Dur"]


@query(
    "a6_null_counts",
    on_flows(" UNION ALL ".join(f"""SELECT '{c}' AS column_name, count(*) FILTER ("{c}" IS NULL) AS nulls FROM flows""" for c in NULLABLE)),
)
def _(t):
    return profile.null_counts(t.flows, NULLABLE)


@query(
    "a7_null_rates_by_protocol",
    on_flows("""SELECT "Proto", round(avg(CASE WHEN "SrcWin" IS NULL THEN 1 ELSE 0 END), 6) AS "SrcWin",
      round(avg(CASE WHEN "dTtl" IS NULL THEN 1 ELSE 0 END), 6) AS "dTtl" FROM flows GROUP BY 1"""),
)
def _(t):
    return rounded(profile.null_rates(t.flows, "Proto", ["SrcWin", "dTtl"]))


CARDINAL = ["Proto", "sDSb", "dDSb", "Cause", "State", "attack_tool", "Dur", "event_id"]


@query(
    "a8_distinct_counts",
    on_flows(" UNION ALL ".join(f"""SELECT '{c}' AS column_name, count(DISTINCT "{c}") AS distinct_values FROM flows""" for c in CARDINAL)),
)
def _(t):
    return profile.distinct_counts(t.flows, CARDINAL)


@query("a8_signed_zero", """SELECT 'z' AS column_name, count(DISTINCT CASE WHEN event_id % 3 = 0 THEN -0.0::double ELSE (event_id % 3 - 1)::double END) AS distinct_values FROM events""")
def _(t):
    return profile.distinct_counts(t.events.selectExpr("CASE WHEN event_id % 3 = 0 THEN -0.0D ELSE CAST(event_id % 3 - 1 AS double) END AS z"), ["z"])


@query(
    "a8_distinct_per_group",
    on_flows('SELECT attack_type, count(DISTINCT "State") AS distinct_values FROM flows GROUP BY 1'),
)
def _(t):
    return profile.distinct_per_group(t.flows, "attack_type", "State")


@query(
    "a9_equal_columns",
    on_flows("""SELECT 'SrcLoss' AS left_column, 'Loss' AS right_column, 1.0::double AS share
      UNION ALL SELECT 'sTtl', 'dTtl', round(avg(CASE WHEN "sTtl" = "dTtl" THEN 1 ELSE 0 END), 6) FROM flows"""),
)
def _(t):
    return rounded(profile.equal_share(t.flows, [("SrcLoss", "Loss"), ("sTtl", "dTtl")]))


@query(
    "a10_numeric_ranges",
    on_flows(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(CAST(min("{c}") AS double), 6) AS min_value, round(CAST(max("{c}") AS double), 6) AS max_value FROM flows"""
        for c in contract.NUMERIC)),
)
def _(t):
    return rounded(profile.numeric_ranges(t.flows.select(*contract.NUMERIC, "Proto")))


@query(
    "a11_group_means",
    on_flows("""SELECT "Label", round(avg("TotBytes"), 6) AS "TotBytes", round(avg("Rate"), 6) AS "Rate",
      round(avg("Dur"), 6) AS "Dur" FROM flows GROUP BY 1"""),
)
def _(t):
    return rounded(profile.group_means(t.flows, "Label", ["TotBytes", "Rate", "Dur"]))


@query(
    "a13_class_audit",
    on_flows("""SELECT attack_type, count("sHops") AS n, round(avg("sHops"), 6) AS mean, round(stddev_samp("sHops"), 6) AS std,
      min("sHops") AS min, max("sHops") AS max FROM flows GROUP BY 1"""),
)
def _(t):
    return rounded(profile.class_audit(t.flows, "attack_type", "sHops"))


@query(
    "a14_exact_quantiles",
    "SELECT l_returnflag, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 6) AS q{int(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9))
    + " FROM lineitem GROUP BY 1",
)
def _(t):
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    found = ordered.exact_quantiles(t.lineitem, "l_extendedprice", probs, ["l_returnflag"])
    return rounded(
        found.select("l_returnflag", *[F.get("quantiles", F.lit(i)).alias(f"q{int(p * 100)}") for i, p in enumerate(probs)])
    )


@query(
    "a16_duplicate_rows",
    """SELECT CAST(sum(n) AS bigint) AS row_count, CAST(sum(n - 1) AS bigint) AS duplicate_rows FROM
      (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_quantity, l_discount, l_tax)""",
)
def _(t):
    return profile.duplicate_rows(t.lineitem, ["l_suppkey", "l_quantity", "l_discount", "l_tax"])


@query(
    "a16_duplicate_flows",
    on_flows("""SELECT (SELECT count(*) FROM flows) AS row_count, (SELECT count(*) FROM flows) - count(*) AS duplicate_rows FROM
      (SELECT DISTINCT * EXCLUDE (event_id, row_id, ingestion_timestamp) FROM flows)"""),
)
def _(t):
    return profile.duplicate_rows(t.flows.drop("event_id", "row_id", "ingestion_timestamp"))


@query("a20_predicted_classes", on_flows(SCORED_SQL + "SELECT count(DISTINCT predicted_class) AS classes FROM scored"))
def _(t):
    return t.scored.agg(F.count_distinct("predicted_class").alias("classes"))


# ---- order of the rows -------------------------------------------------------

SEGMENTS = """, lagged AS (SELECT *, lag("Seq") OVER (ORDER BY row_id) AS before FROM flows),
  resets AS (SELECT *, CASE WHEN "Seq" < before THEN 1 ELSE 0 END AS is_reset FROM lagged),
  segments AS (SELECT *, CAST(sum(is_reset) OVER (ORDER BY row_id ROWS UNBOUNDED PRECEDING) AS bigint) AS segment_id FROM resets)
"""
BLOCKS = """, lagged AS (SELECT *, lag(attack_type) OVER (ORDER BY row_id) AS before FROM flows),
  starts AS (SELECT *, CASE WHEN before IS NULL OR attack_type <> before THEN 1 ELSE 0 END AS is_start FROM lagged),
  blocks AS (SELECT *, CAST(sum(is_start) OVER (ORDER BY row_id ROWS UNBOUNDED PRECEDING) AS bigint) AS block_id FROM starts)
"""


def _narrow(t):
    return t.flows.select("row_id", "Seq", "attack_type")


@query("w2_sequence_resets", on_flows(SEGMENTS + 'SELECT row_id, "Seq", is_reset FROM resets'))
def _(t):
    return profile.with_resets(_narrow(t), "row_id", "Seq").select("row_id", "Seq", "is_reset")


@query("w3_segment_ids", on_flows(SEGMENTS + "SELECT row_id, segment_id FROM segments"))
def _(t):
    return profile.reset_segments(_narrow(t), "row_id", "Seq").select("row_id", "segment_id")


@query("w4_segment_lengths", on_flows(SEGMENTS + "SELECT segment_id, count(*) AS length FROM segments GROUP BY 1"))
def _(t):
    return profile.run_lengths(profile.reset_segments(_narrow(t), "row_id", "Seq"), "segment_id")


@query(
    "w4_mixed_segments",
    on_flows(SEGMENTS + """SELECT count(*) AS segments, count(*) FILTER (n > 1) AS mixed_segments FROM
      (SELECT segment_id, count(DISTINCT attack_type) AS n FROM segments GROUP BY 1)"""),
)
def _(t):
    return profile.mixed_segments(profile.reset_segments(_narrow(t), "row_id", "Seq"), "attack_type")


@query("w5_label_blocks", on_flows(BLOCKS + "SELECT row_id, attack_type, block_id FROM blocks"))
def _(t):
    return profile.label_blocks(_narrow(t), "row_id", "attack_type").select("row_id", "attack_type", "block_id")


@query("w5_blocks_per_label", on_flows(BLOCKS + "SELECT attack_type, CAST(sum(is_start) AS bigint) AS blocks FROM blocks GROUP BY 1"))
def _(t):
    return profile.blocks_per_label(profile.label_blocks(_narrow(t), "row_id", "attack_type"), "attack_type")


@query(
    "a12_describe_blocks",
    on_flows(BLOCKS + """, sizes AS (SELECT block_id, count(*) AS v FROM blocks GROUP BY 1)
      SELECT 'count' AS statistic, CAST(count(*) AS double) AS value FROM sizes
      UNION ALL SELECT 'mean', round(avg(v), 6) FROM sizes UNION ALL SELECT 'std', round(stddev_samp(v), 6) FROM sizes
      UNION ALL SELECT 'min', CAST(min(v) AS double) FROM sizes UNION ALL SELECT 'max', CAST(max(v) AS double) FROM sizes
      UNION ALL SELECT '25%', quantile_cont(v, 0.25) FROM sizes UNION ALL SELECT '50%', quantile_cont(v, 0.5) FROM sizes
      UNION ALL SELECT '75%', quantile_cont(v, 0.75) FROM sizes"""),
)
def _(t):
    blocks = profile.run_lengths(profile.label_blocks(_narrow(t), "row_id", "attack_type"), "block_id")
    return rounded(profile.describe(blocks, "length"))


KS = """, long AS (SELECT "Dur" AS v, ingestion_timestamp < TIMESTAMP '2024-01-15' AS is_ref FROM flows),
  counted AS (SELECT v, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM long GROUP BY 1)
"""


@query(
    "w8_empirical_cdfs",
    on_flows(KS + """SELECT round(v, 6) AS value, round(sum(r) OVER w / sum(r) OVER (), 6) AS cdf_reference,
      round(sum(c) OVER w / sum(c) OVER (), 6) AS cdf_current FROM counted WINDOW w AS (ORDER BY v ROWS UNBOUNDED PRECEDING)"""),
)
def _(t):
    values = drift.counted_values(t.reference, t.current, ["Dur"])
    running = ordered.running_totals(values, "value", {"run_r": "r", "run_c": "c"}, ["feature"], 1)
    return rounded(
        running.select(
            "value", (F.col("run_r") / F.col("run_r_total")).alias("cdf_reference"),
            (F.col("run_c") / F.col("run_c_total")).alias("cdf_current"),
        )
    )


# ---- sorting and sampling ----------------------------------------------------


@query(
    "k2_top_prices",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20",
)
def _(t):
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
        .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(20)
    )


@query(
    "k3_seeded_shuffle",
    on_flows(f"""SELECT event_id, row_number() OVER (ORDER BY {ORDER.format('event_id')}, event_id) AS place FROM flows"""),
)
def _(t):
    return sampling.seeded_places(t.flows.select("event_id"), "event_id")


def _head(n: int, source: str = "flows", id_column: str = "event_id") -> str:
    return f"SELECT {id_column} FROM {source} ORDER BY {ORDER.format(id_column)}, {id_column} LIMIT {n}"


@query("k4_shuffled_head", on_flows(_head(300)))
def _(t):
    return sampling.shuffled_head(t.flows.select("event_id"), 300, "event_id")


@query(
    "k5_sample_per_class",
    on_flows(f"""SELECT event_id, attack_type FROM flows
      QUALIFY row_number() OVER (PARTITION BY attack_type ORDER BY {ORDER.format('event_id')}, event_id) <= 200"""),
)
def _(t):
    return sampling.sample_per_class(t.flows.select("event_id", "attack_type"), "attack_type", 200, "event_id")


@query("k6_fixed_size_sample", "SELECT o_orderkey FROM orders ORDER BY " + ORDER.format("o_orderkey") + ", o_orderkey LIMIT 2000")
def _(t):
    return sampling.sample_rows(t.orders.select("o_orderkey"), 2000, "o_orderkey")


SPLIT = """, ranked AS (SELECT *, row_number() OVER (PARTITION BY attack_type ORDER BY {order}, event_id) AS r,
    count(*) OVER (PARTITION BY attack_type) AS n FROM flows),
  split AS (SELECT *, CASE WHEN r <= (n * 70 + 50) // 100 THEN 'train' WHEN r <= (n * 85 + 50) // 100 THEN 'val' ELSE 'test' END AS split FROM ranked)
""".format(order=ORDER.format("event_id"))


@query("k7_stratified_split", on_flows(SPLIT + "SELECT event_id, attack_type, split FROM split"))
def _(t):
    return sampling.stratified_split(t.flows.select("event_id", "attack_type"), "attack_type", "event_id")


@query(
    "k7_split_orders_by_status",
    f"""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ORDER.format('o_orderkey')}, o_orderkey) AS r,
      count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
      SELECT o_orderkey, CASE WHEN r <= (n * 70 + 50) // 100 THEN 'train' WHEN r <= (n * 85 + 50) // 100 THEN 'val' ELSE 'test' END AS split FROM ranked""",
)
def _(t):
    split = sampling.stratified_split(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")
    return split.select("o_orderkey", "split")


# ---- evaluation of the fixed rule --------------------------------------------

CLASSES = sorted(contract.ATTACK_TYPES)
A17 = SCORED_SQL + "SELECT attack_type AS label, " + ", ".join(
    f"""count(*) FILTER (predicted_class = '{c}') AS "{c}" """ for c in CLASSES
) + " FROM scored GROUP BY 1"


@query("a17_confusion_matrix", on_flows(A17))
def _(t):
    return evaluate.confusion_matrix(t.scored, "attack_type", "predicted_class", CLASSES)
