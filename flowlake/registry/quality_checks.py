"""Data checks, on clean flows and on flows with planted faults."""

from pyspark.sql import functions as F

from flowlake import contract
from flowlake.operators import quality
from flowlake.plans import marts
from flowlake.registry.core import on_flows, query, rounded
from flowlake.registry.mart_checks import A1, QUALITY, TRAFFIC
from flowlake.sources import readers
from flowlake.streaming import ingest


def _faulty(t):
    """Some rows break each kind of rule, and one id repeats very often."""
    n = F.col("row_id")
    return t.flows.withColumns(
        {
            "event_id": F.when(n % 10 == 3, "evt_hot").when(n % 100 == 7, F.lit(None)).otherwise(F.col("event_id")),
            "Proto": F.when(n % 50 == 0, "gre").otherwise(F.col("Proto")),
            "Dur": F.when(n % 40 == 1, -F.col("Dur") - 1).otherwise(F.col("Dur")),
            "TotPkts": F.when(n % 30 == 2, F.lit(None)).otherwise(F.col("TotPkts")),
            "attack_type": F.when(n % 70 == 5, "Unknown").when(n % 90 == 6, F.lit(None)).otherwise(F.col("attack_type")),
            "is_tcp": F.when(n % 60 == 8, 2).otherwise(F.col("is_tcp")),
        }
    )


FAULTY_SQL = """, faulty AS (SELECT * REPLACE (
    CASE WHEN row_id % 10 = 3 THEN 'evt_hot' WHEN row_id % 100 = 7 THEN NULL ELSE event_id END AS event_id,
    CASE WHEN row_id % 50 = 0 THEN 'gre' ELSE "Proto" END AS "Proto",
    CASE WHEN row_id % 40 = 1 THEN -"Dur" - 1 ELSE "Dur" END AS "Dur",
    CASE WHEN row_id % 30 = 2 THEN NULL ELSE "TotPkts" END AS "TotPkts",
    CASE WHEN row_id % 70 = 5 THEN 'Unknown' WHEN row_id % 90 = 6 THEN NULL ELSE attack_type END AS attack_type,
    CASE WHEN row_id % 60 = 8 THEN 2 ELSE is_tcp END AS is_tcp) FROM flows)
"""


def _suite_sql(source: str, suite) -> str:
    parts = []
    for position, check in enumerate(suite, start=1):
        column = f'"{check.column}"'
        head = f"SELECT {position} AS position, '{check.kind}' AS expectation, '{check.column}' AS \"column\""
        if check.kind == quality.COLUMNS_MATCH:
            parts.append(
                f"{head}, true AS success, CAST(NULL AS bigint) AS element_count, 0::bigint AS unexpected_count, 0.0::double AS unexpected_percent"
            )
            continue
        if check.kind == quality.UNIQUE:
            parts.append(
                f"{head}, count(*) FILTER (v IS NOT NULL AND c > 1) = 0 AS success, CAST(sum(c) AS bigint) AS element_count, "
                "CAST(coalesce(sum(c) FILTER (v IS NOT NULL AND c > 1), 0) AS bigint) AS unexpected_count, "
                "round(100.0::double * coalesce(sum(c) FILTER (v IS NOT NULL AND c > 1), 0) / sum(c) FILTER (v IS NOT NULL), 6) "
                "AS unexpected_percent "
                f"FROM (SELECT {column} AS v, count(*) AS c FROM {source} GROUP BY 1)"
            )
            continue
        checked = f"count({column})"
        if check.kind == quality.NOT_NULL:
            bad, checked = f"{column} IS NULL", "count(*)"
        elif check.kind == quality.IN_SET:
            values = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in check.values)
            bad = f"{column} NOT IN ({values})"
        else:
            bad = f"{column} < {check.minimum}"
        parts.append(
            f"{head}, count(*) FILTER ({bad}) = 0 AS success, count(*) AS element_count, "
            f"count(*) FILTER ({bad}) AS unexpected_count, "
            f"round(100.0::double * count(*) FILTER ({bad}) / {checked}, 6) AS unexpected_percent FROM {source}"
        )
    return " UNION ALL ".join(parts)


SUITE = quality.silver_suite()


def _broken_sql(suite) -> str:
    """The names of the rules that a row breaks, in the order of the suite."""
    cases = []
    for check in suite:
        column = f'"{check.column}"'
        if check.kind in (quality.COLUMNS_MATCH, quality.UNIQUE):
            continue
        if check.kind == quality.NOT_NULL:
            bad = f"{column} IS NULL"
        elif check.kind == quality.IN_SET:
            bad = f"{column} NOT IN ({', '.join(repr(v) for v in check.values)})"
        else:
            bad = f"{column} < {check.minimum}"
        cases.append(f"CASE WHEN {bad} THEN '{check.kind}({check.column})' END")
    return f"concat_ws(';', {', '.join(cases)})"


@query(
    "q10_row_quarantine",
    on_flows(FAULTY_SQL + f"""SELECT event_id, "TotPkts", {_broken_sql(SUITE)} AS broken_rules, {_broken_sql(SUITE)} = '' AS valid FROM faulty"""),
)
def _(t):
    """Valid and invalid rows stored as one batch, written again as after a restart."""
    root, flows = t.scratch("quarantine"), _faulty(t).drop("row_id", "Seq")
    step = ingest.quarantine_batch_writer(root)
    for batch in (0, 1, 0):
        step(flows.filter(F.pmod(F.xxhash64("Dur"), F.lit(2)) == batch), batch)
    good = ingest.read_valid(t.spark, root).select("event_id", "TotPkts", F.lit("").alias("broken_rules"), F.lit(True).alias("valid"))
    bad = ingest.read_quarantine(t.spark, root).select("event_id", "TotPkts", F.concat_ws(";", "broken_rules").alias("broken_rules"), F.lit(False).alias("valid"))
    return good.unionAll(bad)


@query(
    "q5_ids_over_batches",
    on_flows(FAULTY_SQL + "SELECT event_id, count(*) > 1 AS repeated FROM faulty WHERE event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    " UNION ALL SELECT event_id, true FROM flows WHERE row_id % 10 = 4"),
)
def _(t):
    """A stream with a hot id and ids that come again in a later batch, stopped and started again in between."""
    from flowlake.registry.stream_checks import as_records
    from flowlake.sources import writers

    root = t.scratch("ids")
    faulty = _faulty(t).filter("event_id IS NOT NULL")
    waves = [faulty, t.flows.filter("row_id % 10 = 4"), t.flows.filter("row_id % 10 = 4")]
    for wave in waves:
        spaced = wave.withColumnsRenamed({v: k for k, v in contract.LABEL_RENAMES.items()})
        events = writers.as_events(spaced, F.col("ingestion_timestamp"), content=[F.col("row_id")])
        # The event's own id is kept: it is what repeats.
        value = F.regexp_replace("value", '"event_id":"[^"]*"', F.concat(F.lit('"event_id":"'), F.col("id"), F.lit('"')))
        keyed = events.withColumnRenamed("key", "made").join(
            spaced.select("event_id", F.col("row_id"), writers.event_id(F.lit(contract.SCHEMA_VERSION), F.col("row_id")).alias("made")).withColumnRenamed("event_id", "id"), "made"
        )
        as_records(keyed.select(F.col("id").alias("key"), value.alias("value"))).write.mode("append").json(f"{root}/topic")
        records = readers.event_stream(t.spark, "json", f"{root}/topic")
        ingest.finish([ingest.start_id_watch(records, f"{root}/repeated", f"{root}/progress", None, delay="400 days")])
    return ingest.read_repeated_ids(t.spark, f"{root}/repeated").select("event_id", F.lit(True).alias("repeated"))


@query("q6_suite_on_clean_flows", on_flows(_suite_sql("flows", SUITE)))
def _(t):
    return rounded(quality.validate(t.flows, SUITE))


@query("q6_suite_on_faulty_flows", on_flows(FAULTY_SQL + _suite_sql("faulty", SUITE)))
def _(t):
    return rounded(quality.validate(_faulty(t), SUITE))


def _one(kind: str) -> list:
    return [check for check in SUITE if check.kind == kind]


@query("q1_columns_present", on_flows("""SELECT 1 AS position, 'expect_table_columns_to_match_set' AS expectation, '?' AS "column",
  false AS success, CAST(NULL AS bigint) AS element_count, 2::bigint AS unexpected_count, round(200.0::double / 47, 6) AS unexpected_percent
  FROM (SELECT count(*) FROM flows)"""))
def _(t):
    return rounded(quality.validate(t.flows.drop("Dur", "Proto"), _one(quality.COLUMNS_MATCH)))


for _name, _kind in (
    ("q2_not_null", quality.NOT_NULL), ("q3_in_set", quality.IN_SET),
    ("q4_non_negative", quality.BETWEEN), ("q5_unique", quality.UNIQUE),
):

    @query(_name, on_flows(FAULTY_SQL + _suite_sql("faulty", _one(_kind))))
    def _(t, kind=_kind):
        return rounded(quality.validate(_faulty(t), _one(kind)))


@query(
    "q7_batch_record",
    on_flows(FAULTY_SQL + f""", results AS ({_suite_sql("faulty", SUITE)})
      SELECT (SELECT count(*) FROM faulty) AS row_count, bool_and(success) AS success,
        count(*) FILTER (NOT success) AS n_failed_expectations,
        string_agg(expectation || '(' || "column" || ')', '; ' ORDER BY position) FILTER (NOT success) AS failed_expectation_summary
      FROM results"""),
)
def _(t):
    record = quality.batch_record(quality.validate(_faulty(t), SUITE).collect(), 0)
    log = t.spark.createDataFrame([record], quality.LOG_SCHEMA)
    return log.select("row_count", "success", "n_failed_expectations", "failed_expectation_summary")


def _tests_sql() -> str:
    sources = {
        "stg_flows": "faulty", "mart_attack_summary": "by_attack", "mart_traffic_by_hour": "traffic",
        "mart_protocol_breakdown": "protocols", "mart_quality_summary": "summary",
    }
    parts = []
    for test in quality.SCHEMA_TESTS:
        source, column = sources[test.model], f'"{test.column}"'
        if test.rule == "not_null":
            failures = f"(SELECT count(*) FROM {source} WHERE {column} IS NULL)"
        elif test.rule == "unique":
            failures = (
                f"(SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
            )
        else:
            values = ", ".join(f"'{v}'" for v in test.values)
            failures = f"(SELECT count(DISTINCT {column}) FROM {source} WHERE {column} NOT IN ({values}))"
        parts.append(
            f"SELECT '{test.model}' AS model, '{test.column}' AS \"column\", '{test.rule}' AS rule, {failures} AS failures, {failures} = 0 AS passed"
        )
    return " UNION ALL ".join(parts)


# The quality summary opens its own WITH; here it continues the list of the flows.
LOG_PART = ", " + QUALITY.removeprefix("WITH ")
PROTOCOLS = """, protocols AS (SELECT "Proto" AS proto, attack_type, count(*) AS flow_count FROM flows GROUP BY 1, 2)
"""
TRAFFIC_PART = TRAFFIC[TRAFFIC.index(", traffic AS") :]


@query("q9_schema_tests", on_flows(FAULTY_SQL + A1 + TRAFFIC_PART + PROTOCOLS + LOG_PART + _tests_sql()))
def _(t):
    models = {
        "stg_flows": marts.staging_flows(_faulty(t)),
        "mart_attack_summary": marts.attack_summary(t.staging),
        "mart_traffic_by_hour": marts.traffic_by_hour(t.staging),
        "mart_protocol_breakdown": marts.protocol_breakdown(t.staging),
        "mart_quality_summary": marts.quality_summary(t.quality_log),
    }
    return quality.schema_tests(models)


@query(
    "q11_load_checks",
    on_flows("""SELECT 'rows' AS "check", CAST(NULL AS varchar) AS attack_type, count(*) AS flows FROM flows
      UNION ALL SELECT 'by attack', attack_type, count(*) FROM flows GROUP BY 2"""),
)
def _(t):
    total = t.staging.agg(F.count(F.lit(1)).alias("flows")).select(
        F.lit("rows").alias("check"), F.lit(None).cast("string").alias("attack_type"), "flows"
    )
    by_attack = (
        marts.attack_summary(t.staging).groupBy("attack_type").agg(F.sum("flow_count").alias("flows"))
        .select(F.lit("by attack").alias("check"), "attack_type", "flows")
    )
    return total.unionByName(by_attack)
