"""Declarative data checks on batches, micro-batches and marts.

All simple checks of a suite are one aggregate over one scan. Each uniqueness
check adds one shuffle of its key, with partial counts before it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from flowlake import contract
from flowlake.functions.scalar import failure_summary, quoted

# Check names as they appear in the log, and the columns that
# must not be negative.
COLUMNS_MATCH = "expect_table_columns_to_match_set"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
NON_NEGATIVE = (
    "Dur", "TotPkts", "SrcPkts", "DstPkts", "TotBytes", "SrcBytes", "DstBytes",
    "sMeanPktSz", "dMeanPktSz", "Load", "SrcLoad", "DstLoad",
    "Loss", "SrcLoss", "DstLoss", "pLoss", "Rate", "SrcRate", "DstRate",
    "TcpRtt", "SynAck", "AckDat",
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("success", T.BooleanType(), False),
        T.StructField("n_failed_expectations", T.LongType(), False),
        T.StructField("failed_expectation_summary", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str = "?"
    values: tuple = ()
    minimum: float | None = None

    def broken(self) -> str:
        """Condition under which a value breaks the rule. Only the null rule looks at nulls."""
        value = name_sql(self.column)
        if self.kind == NOT_NULL:
            return f"{value} IS NULL"
        if self.kind == IN_SET:
            return f"{value} NOT IN ({', '.join(value_sql(v) for v in self.values)})"
        if self.kind == BETWEEN:
            return f"{value} < {self.minimum}"
        raise ValueError(f"{self.kind} has no row rule")


def name_sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def value_sql(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def silver_suite() -> list[Expectation]:
    """The 61 checks on parsed flows, derived from the contract."""
    required = [*contract.REQUIRED, "Label", "attack_type", "attack_tool", "event_id", "schema_version"]
    domains = {
        "Proto": contract.PROTOCOLS,
        "Cause": contract.CAUSES,
        "Label": contract.BINARY_LABELS,
        "attack_type": contract.ATTACK_TYPES,
        "attack_tool": contract.ATTACK_TOOLS,
        "is_tcp": (0, 1),
        "has_dst_reply": (0, 1),
    }
    return [
        Expectation(COLUMNS_MATCH, values=contract.SILVER_COLUMNS),
        *[Expectation(NOT_NULL, name) for name in required],
        *[Expectation(IN_SET, name, values=tuple(v)) for name, v in domains.items()],
        *[Expectation(BETWEEN, name, minimum=0) for name in NON_NEGATIVE],
        Expectation(UNIQUE, "event_id"),
    ]


def _result(position: int, check: Expectation, total: str, checked: str, bad: str) -> str:
    return (
        f"named_struct('position', {position}, 'expectation', {value_sql(check.kind)}, "
        f"'column', {value_sql(check.column)}, 'success', {bad} = 0, "
        f"'element_count', {total}, 'unexpected_count', {bad}, "
        f"'unexpected_percent', CASE WHEN {checked} > 0 THEN 100.0D * {bad} / {checked} ELSE 0.0D END)"
    )


def _fixed(position: int, check: Expectation, success: bool, bad: int | None, percent: float | None) -> str:
    count = "NULL" if bad is None else str(bad)
    share = "NULL" if percent is None else repr(percent)
    return (
        f"named_struct('position', {position}, 'expectation', {value_sql(check.kind)}, "
        f"'column', {value_sql(check.column)}, 'success', {str(success).lower()}, "
        f"'element_count', CAST(NULL AS bigint), 'unexpected_count', CAST({count} AS bigint), "
        f"'unexpected_percent', CAST({share} AS double))"
    )


class Suite:
    """Checks turned into expressions once, for tables with the same columns.

    A stream builds it before the first micro-batch and runs it on every one.
    """

    def __init__(self, checks: list[Expectation], columns: list[str]):
        self.checks = list(checks)
        present = set(columns)
        aggregates, rows = ["count(1) AS total"], []
        self.unique: list[tuple[int, Expectation]] = []
        for position, check in enumerate(self.checks, start=1):
            if check.kind == COLUMNS_MATCH:
                absent = len([name for name in check.values if name not in present])
                rows.append(_fixed(position, check, absent == 0, absent, 100.0 * absent / len(check.values)))
            elif check.column not in present:
                rows.append(_fixed(position, check, False, None, None))
            elif check.kind == UNIQUE:
                self.unique.append((position, check))
            else:
                aggregates.append(f"count_if({check.broken()}) AS bad{position}")
                checked = "total"
                if check.kind != NOT_NULL:
                    checked = f"n_{columns.index(check.column)}"
                    counted = f"count({name_sql(check.column)}) AS {checked}"
                    if counted not in aggregates:
                        aggregates.append(counted)
                rows.append(_result(position, check, "total", checked, f"bad{position}"))
        self.aggregates = [F.expr(text) for text in aggregates]
        self.rows = f"inline(array({', '.join(rows)}))" if rows else None

    def validate(self, df: DataFrame) -> DataFrame:
        """One result row per check: success, unexpected count and percent.

        The percent is over non-null values, for the null check over all rows. A
        check on a column that is not there fails with null counts.
        """
        parts = []
        if self.rows:
            parts.append(df.agg(*self.aggregates).selectExpr(self.rows))
        for position, check in self.unique:
            # Every member of a repeated group is unexpected; nulls are not looked at.
            counted = df.groupBy(quoted(check.column).alias("v")).agg(F.count(F.lit(1)).alias("c"))
            sums = counted.agg(
                F.expr("coalesce(sum(c), 0) AS total"),
                F.expr("coalesce(sum(c) FILTER (WHERE v IS NOT NULL), 0) AS checked"),
                F.expr("coalesce(sum(c) FILTER (WHERE v IS NOT NULL AND c > 1), 0) AS bad"),
            )
            parts.append(sums.selectExpr(f"inline(array({_result(position, check, 'total', 'checked', 'bad')}))"))
        return reduce(DataFrame.unionByName, parts)


def validate(df: DataFrame, checks: list[Expectation]) -> DataFrame:
    """Run checks on one table; see :class:`Suite`."""
    return Suite(checks, df.columns).validate(df)


def broken_rules(checks: list[Expectation], columns: list[str]) -> Column:
    """The rules that a row breaks, as an array of names in the order of the suite; empty for a valid row.

    Rules on a column that is not there are broken by every row. Uniqueness and the set of columns are
    not rules of a row."""
    names = []
    for check in checks:
        if check.kind in (COLUMNS_MATCH, UNIQUE):
            continue
        name = F.lit(f"{check.kind}({check.column})")
        names.append(F.when(F.expr(check.broken()), name) if check.column in columns else name)
    return F.filter(F.array(*names), lambda n: n.isNotNull()) if names else F.array().cast("array<string>")


def batch_record(results: list[Row], batch_id: int, now: datetime | None = None) -> dict:
    """The log row of a validated batch, from its collected results: one row per check."""
    failed = [
        f"{row['expectation']}({row['column']})"
        for row in sorted(results, key=lambda row: row["position"]) if not row["success"]
    ]
    return {
        "event_timestamp": now or datetime.now(timezone.utc),
        "batch_id": int(batch_id),
        "row_count": max((row["element_count"] or 0 for row in results), default=0),
        "success": not failed,
        "n_failed_expectations": len(failed),
        "failed_expectation_summary": failure_summary(failed),
    }


@dataclass(frozen=True)
class SchemaTest:
    model: str
    column: str
    rule: str
    values: tuple = ()


# The checks on staging and mart tables.
SCHEMA_TESTS = (
    SchemaTest("stg_flows", "event_id", "unique"),
    SchemaTest("stg_flows", "event_id", "not_null"),
    SchemaTest("stg_flows", "label", "not_null"),
    SchemaTest("stg_flows", "label", "accepted_values", contract.BINARY_LABELS),
    SchemaTest("stg_flows", "attack_type", "not_null"),
    SchemaTest("stg_flows", "attack_type", "accepted_values", contract.ATTACK_TYPES),
    SchemaTest("stg_flows", "proto", "not_null"),
    SchemaTest("stg_flows", "proto", "accepted_values", contract.PROTOCOLS),
    SchemaTest("stg_flows", "dur", "not_null"),
    SchemaTest("mart_attack_summary", "attack_type", "not_null"),
    SchemaTest("mart_attack_summary", "attack_category", "not_null"),
    SchemaTest("mart_attack_summary", "attack_category", "accepted_values", ("Benign", "DoS", "Reconnaissance")),
    SchemaTest("mart_attack_summary", "flow_count", "not_null"),
    SchemaTest("mart_traffic_by_hour", "flow_hour", "not_null"),
    SchemaTest("mart_traffic_by_hour", "label", "not_null"),
    SchemaTest("mart_protocol_breakdown", "proto", "not_null"),
    SchemaTest("mart_quality_summary", "batch_hour", "not_null"),
    SchemaTest("mart_quality_summary", "pass_rate_pct", "not_null"),
)


def schema_tests(models: dict[str, DataFrame], tests=SCHEMA_TESTS) -> DataFrame:
    """One row per check with its failures.

    ``not_null`` counts rows, ``unique`` counts repeated values and
    ``accepted_values`` counts distinct values outside the list; nulls pass the
    last two.
    """
    parts = []
    for name, df in models.items():
        mine = [t for t in tests if t.model == name]
        if not mine:
            continue
        aggregates, rows = [], []
        for i, test in enumerate(mine):
            value = quoted(test.column)
            if test.rule == "not_null":
                aggregates.append(F.count_if(value.isNull()).alias(f"f{i}"))
            elif test.rule == "accepted_values":
                aggregates.append(F.count_distinct(F.when(~value.isin(*test.values), value)).alias(f"f{i}"))
            else:
                # Only one column is read, and only repeated values are counted.
                failing = (
                    df.filter(value.isNotNull()).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("c"))
                    .agg(F.count_if(F.col("c") >= 2).alias("failures"))
                )
                parts.append(
                    failing.select(
                        F.lit(name).alias("model"), F.lit(test.column).alias("column"),
                        F.lit(test.rule).alias("rule"), "failures",
                    )
                )
                continue
            rows.append(
                F.struct(
                    F.lit(name).alias("model"), F.lit(test.column).alias("column"),
                    F.lit(test.rule).alias("rule"), F.col(f"f{i}").alias("failures"),
                )
            )
        if rows:
            parts.append(df.agg(*aggregates).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)
