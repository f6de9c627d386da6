from pyspark.sql import functions as F

from flowlake.operators import quality
from flowlake.operators.quality import BETWEEN, COLUMNS_MATCH, IN_SET, NOT_NULL, UNIQUE, Expectation

ROWS = [("a", 1.0, "x"), ("a", -2.0, "y"), (None, None, None), (None, 3.0, "z'"), ("b", 0.0, "x")]


def run(spark, rows, checks, schema="id string, v double, kind string"):
    found = quality.validate(spark.createDataFrame(rows, schema), checks).collect()
    return [row.asDict() for row in sorted(found, key=lambda r: r["position"])]


def test_suite_has_61_checks():
    suite = quality.silver_suite()
    kinds = [check.kind for check in suite]
    assert len(suite) == 61
    assert [kinds.count(k) for k in (COLUMNS_MATCH, NOT_NULL, IN_SET, BETWEEN, UNIQUE)] == [1, 30, 7, 22, 1]
    assert Expectation(NOT_NULL, "ingestion_timestamp") not in suite


def test_each_rule(spark):
    found = run(
        spark, ROWS,
        [
            Expectation(NOT_NULL, "v"), Expectation(IN_SET, "kind", values=("x", "y", "z'")),
            Expectation(IN_SET, "kind", values=("x",)), Expectation(BETWEEN, "v", minimum=0), Expectation(UNIQUE, "id"),
            Expectation(COLUMNS_MATCH, values=("id", "v")), Expectation(COLUMNS_MATCH, values=("id", "w")),
            Expectation(NOT_NULL, "absent"),
        ],
    )
    outcome = [(r["success"], r["unexpected_count"]) for r in found]
    assert outcome == [
        (False, 1), (True, 0), (False, 2), (False, 1), (False, 2), (True, 0), (False, 1), (False, None),
    ]
    # The null check counts all rows, the others only values.
    assert [round(r["unexpected_percent"], 6) for r in found[:5]] == [20.0, 0.0, 50.0, 25.0, 66.666667]


def test_repeated_nulls_are_unique(spark):
    found = run(spark, [(None, 1.0, "x"), (None, 1.0, "x"), ("a", 1.0, "x")], [Expectation(UNIQUE, "id")])
    assert found[0]["success"] and found[0]["unexpected_percent"] == 0.0


def test_empty_table_passes(spark):
    found = run(spark, [], [Expectation(NOT_NULL, "v"), Expectation(UNIQUE, "id"), Expectation(BETWEEN, "v", minimum=0)])
    assert all(r["success"] and r["unexpected_count"] == 0 for r in found)


def test_suite_is_one_scan_and_one_shuffle_of_the_id(spark, flows):
    plan = quality.validate(flows, quality.silver_suite())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1
    assert plan.count("Aggregate") == 3  # all simple checks, id counts, id totals


def test_record_lists_all_failures(spark):
    checks = [Expectation(NOT_NULL, "v") for _ in range(12)]
    record = quality.batch_record(quality.validate(spark.createDataFrame(ROWS, "id string, v double, kind string"), checks).collect(), 7)
    assert record["batch_id"] == 7 and record["row_count"] == 5 and not record["success"]
    assert record["n_failed_expectations"] == 12
    assert record["failed_expectation_summary"] == "; ".join(["expect_column_values_to_not_be_null(v)"] * 12)


def test_schema_tests_count_failures(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "q"), ("b", None), (None, "q"), ("b", "r")], "k string, kind string")
    tests = [
        quality.SchemaTest("m", "k", "unique"), quality.SchemaTest("m", "k", "not_null"),
        quality.SchemaTest("m", "kind", "accepted_values", ("x",)), quality.SchemaTest("m", "kind", "not_null"),
    ]
    found = {(r["column"], r["rule"]): (r["failures"], r["passed"]) for r in quality.schema_tests({"m": df}, tests).collect()}
    assert found == {
        ("k", "unique"): (2, False), ("k", "not_null"): (1, False),
        ("kind", "accepted_values"): (2, False), ("kind", "not_null"): (1, False),
    }
    assert len(quality.SCHEMA_TESTS) == 18


def test_order_of_rows_does_not_matter(spark, flows):
    suite = quality.silver_suite()
    once = quality.validate(flows, suite).orderBy("position").collect()
    shuffled = quality.validate(flows.orderBy(F.rand(1)).repartition(5), suite).orderBy("position").collect()
    assert once == shuffled
