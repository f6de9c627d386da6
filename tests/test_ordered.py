import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from flowlake.operators import ordered, profile


def frame(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-100, 100, width=16), min_size=1, max_size=60))
def test_quantiles_equal_sorted_interpolation(spark, values):
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = ordered.exact_quantiles(frame(spark, values), "v", probs).first()["quantiles"]
    assert np.allclose(found, np.quantile(values, probs), rtol=1e-12, atol=1e-12)


def test_quantiles_per_group_leave_out_nulls(spark):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("b", 5.0), (None, 7.0), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r["g"]: r["quantiles"] for r in ordered.exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert found == {"a": [2.0], "b": [5.0], None: [7.0]}


def test_running_totals_cross_ranges(spark):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 5, 500).astype(float)
    df = frame(spark, values).repartition(7)
    found = ordered.running_totals(df, "i", {"run": "v"}).orderBy("i").collect()
    assert [r["run"] for r in found] == list(np.cumsum(values))
    assert {r["run_total"] for r in found} == {values.sum()}
    assert len({r[ordered.BUCKET] for r in found}) > 4


def test_previous_value_crosses_ranges_and_keeps_nulls(spark):
    values = [None if i % 5 == 0 else float(i) for i in range(200)]
    df = spark.createDataFrame([(i * 1000, v) for i, v in enumerate(values)], "i long, v double").repartition(6)
    found = ordered.previous_value(df, "i", "v", "prev").orderBy("i").collect()
    assert found[0]["prev"] is None
    assert [r["prev"]["value"] for r in found[1:]] == values[:-1]


def test_ranges_are_even_for_clustered_keys(spark):
    # A third of all keys lies in a narrow cluster far from the rest.
    keys = list(range(0, 2_000_000, 1000)) + list(range(10**15, 10**15 + 1000))
    df = spark.createDataFrame([(k,) for k in keys], "i long")
    sizes = [r["count"] for r in ordered.with_ranges(df, "i").groupBy(ordered.BUCKET).count().collect()]
    assert max(sizes) < 3 * len(keys) / len(sizes)


def test_empty_input(spark):
    df = spark.createDataFrame([], "i long, v double")
    assert ordered.running_totals(df, "i", {"run": "v"}).count() == 0
    assert ordered.previous_value(df, "i", "v", "p").count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_segments_and_blocks_equal_a_plain_scan(spark, seed):
    rng = np.random.default_rng(seed)
    seq, kinds = rng.integers(0, 6, 300), rng.integers(0, 3, 300)
    df = spark.createDataFrame(
        [(int(i), int(s), str(k)) for i, (s, k) in enumerate(zip(seq, kinds))], "row_id long, Seq long, kind string"
    ).repartition(5)
    segments = [r["segment_id"] for r in profile.reset_segments(df, "row_id", "Seq").orderBy("row_id").collect()]
    assert segments == list(np.cumsum(np.r_[0, seq[1:] < seq[:-1]]))
    blocks = [r["block_id"] for r in profile.label_blocks(df, "row_id", "kind").orderBy("row_id").collect()]
    assert blocks == list(np.cumsum(np.r_[1, kinds[1:] != kinds[:-1]]))


def test_null_labels_start_blocks(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, None), (3, "a"), (4, "a")], "row_id long, kind string")
    found = [r["block_id"] for r in profile.label_blocks(df, "row_id", "kind").orderBy("row_id").collect()]
    assert found == [1, 2, 3, 4, 4]


def test_describe_equals_pandas(spark):
    values = [1.0, 2.0, 2.0, 7.5, 11.0, 100.0]
    found = {r["statistic"]: r["value"] for r in profile.describe(frame(spark, values), "v").collect()}
    import pandas as pd

    for name, value in pd.Series(values).describe().items():
        assert found[name] == pytest.approx(value)


def test_duplicates_count_repeats_and_nulls_alike(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a"), (1, "a")], "x int, y string")
    assert tuple(profile.duplicate_rows(df).first()) == (6, 3)


def test_profile_of_columns(spark):
    df = spark.createDataFrame([(1.0, 1.0, "a"), (2.0, None, "a"), (None, None, None)], "x double, y double, k string")
    assert {r[0]: r[1] for r in profile.null_counts(df).collect()} == {"x": 1, "y": 2, "k": 1}
    assert {r[0]: r[1] for r in profile.distinct_counts(df, ["x", "y", "k"]).collect()} == {"x": 2, "y": 1, "k": 1}
    assert profile.equal_share(df, [("x", "y")]).first()["share"] == pytest.approx(1 / 3)
    ranges = {r["column_name"]: (r["min_value"], r["max_value"]) for r in profile.numeric_ranges(df).collect()}
    assert ranges == {"x": (1.0, 2.0), "y": (1.0, 1.0)}
    assert [tuple(r) for r in profile.value_counts(df, "k").collect()] == [("a", 2)]


def test_histogram_closes_only_the_last_bin(spark):
    df = frame(spark, [-1.0, 0.0, 0.5, 1.0, 2.0, 2.1])
    found = {r["bin"]: r["n"] for r in profile.histogram(df, "v", [0.0, 1.0, 2.0]).collect()}
    assert found == {1: 2, 2: 2}


def test_boundaries_are_fixed_before_use(spark):
    """All branches of a plan must see the same ranges, so no branch may compute the sketch itself."""
    df = spark.range(100).selectExpr("id", "id % 3 AS g", "CAST(id AS double) AS v")
    for groups in ([], ["g"]):
        plan = ordered.running_totals(df, "id", {"run": "v"}, groups)._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile_approx" not in plan


def test_carry_join_does_not_shuffle_rows_again(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS g", "CAST(id AS double) AS v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ordered.running_totals(df, "id", {"run": "v"}, ["g"], 3)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    left = plan[plan.index("SortMergeJoin") :].split("__carry_range")[1].split("+- Sort [__g")[0]
    assert left.count("Exchange hashpartitioning") == 1


def test_many_groups_go_through_files(spark, monkeypatch):
    df = spark.range(200).selectExpr("id", "id % 20 AS g", "CAST(1 AS double) AS v")
    few = ordered.running_totals(df, "id", {"run": "v"}, ["g"]).select("id", "run", "run_total").orderBy("id").collect()
    monkeypatch.setattr(ordered, "MAX_GROUPS", 5)
    many = ordered.running_totals(df, "id", {"run": "v"}, ["g"]).select("id", "run", "run_total").orderBy("id").collect()
    assert few == many and {r["run_total"] for r in few} == {10.0}
