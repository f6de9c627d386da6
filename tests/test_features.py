import math

import pytest
from pyspark.sql import functions as F

from flowlake import contract
from flowlake.functions import scalar
from flowlake.operators import features


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        ("a", 1.0, "tcp", "Start", None, 10, 4, 64.0),
        ("b", 2.0, "udp", "Odd", "ef", 5, 0, None),
        ("c", None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(
        rows, "event_id string, Dur double, Proto string, Cause string, sDSb string, TotPkts long, DstPkts long, dTtl double"
    )


def test_indicators_use_raw_values(raw):
    found = {r["event_id"]: (r["is_tcp"], r["has_dst_reply"]) for r in features.add_indicators(raw).collect()}
    assert found == {"a": (1, 1), "b": (0, 0), "c": (0, 0)}
    bare = features.add_indicators(raw.drop("Proto", "dTtl")).first()
    assert (bare["is_tcp"], bare["has_dst_reply"]) == (0, 0)


def test_sentinel_fills_numbers_only(raw):
    row = features.fill_sentinel(raw).filter("event_id = 'c'").first()
    assert (row["Dur"], row["TotPkts"], row["dTtl"]) == (-1.0, -1, -1.0)
    assert row["Proto"] is None


def test_vocabulary_is_sorted_without_nulls(raw):
    assert features.vocabulary(raw) == {"Proto": ["tcp", "udp"], "Cause": ["Odd", "Start"], "sDSb": ["ef"]}


def test_unknown_and_null_levels_are_zero(raw):
    encoder = features.FlowEncoder({"Proto": ["icmp", "tcp"], "Cause": ["Start"]})
    found = {r["event_id"]: r for r in encoder.transform(raw, ["event_id"]).collect()}
    assert [found[k]["Proto_tcp"] for k in "abc"] == [1.0, 0.0, 0.0]
    assert [found[k]["Proto_icmp"] for k in "abc"] == [0.0, 0.0, 0.0]
    assert [found[k]["Cause_Start"] for k in "abc"] == [1.0, 0.0, 0.0]
    assert found["a"]["Rate"] == 0.0  # a column the table lacks


def test_matrix_order_and_type(raw):
    encoder = features.FlowEncoder.fit(raw, engineer=True)
    matrix = encoder.transform(raw)
    assert matrix.columns == encoder.columns
    assert matrix.columns[:34] == list(contract.NUMERIC) and matrix.columns[34:36] == ["is_tcp", "has_dst_reply"]
    assert matrix.columns[-6:] == list(features.ENGINEERED)
    assert {f.dataType.typeName() for f in matrix.schema} == {"double"}


def test_full_contract_gives_76_columns():
    levels = {"Proto": 8, "Cause": 3, "State": 11, "sDSb": 12, "dDSb": 6}
    encoder = features.FlowEncoder({name: [f"v{i}" for i in range(n)] for name, n in levels.items()})
    assert len(encoder.columns) == 76
    assert len(features.FlowEncoder(encoder.levels, engineer=True).columns) == 82


def test_case_does_not_matter(raw):
    encoder = features.FlowEncoder.fit(raw)
    plain = encoder.transform(raw, ["event_id"]).orderBy("event_id").collect()
    upper = contract.upper_columns(raw).withColumnRenamed("EVENT_ID", "event_id")
    assert encoder.transform(upper, ["event_id"]).orderBy("event_id").collect() == plain


def test_a_table_without_features_is_refused(spark):
    with pytest.raises(ValueError):
        features.FlowEncoder({}).transform(spark.createDataFrame([(1,)], "foo int"))


def test_engineered_values(spark):
    df = spark.createDataFrame(
        [(100, 9, 6, 2, 50, 4, -3.0), (7, -1, 6, -1, 0, -1, 0.0)],
        "TotBytes long, TotPkts long, SrcPkts long, DstPkts long, SrcBytes long, DstBytes long, Rate double",
    )
    first, second = features.add_engineered(df).collect()
    assert first["bytes_per_packet"] == 10.0 and first["src_dst_pkt_ratio"] == 2.0 and first["src_dst_byte_ratio"] == 10.0
    assert first["log_rate"] == 0.0 and first["log_totbytes"] == pytest.approx(math.log(101))
    # A denominator of -1 + 1 divides by zero: infinity and NaN, and no failure.
    assert second["bytes_per_packet"] == math.inf and math.isnan(second["src_dst_byte_ratio"])


def test_encoder_survives_text(raw):
    encoder = features.FlowEncoder.fit(raw, engineer=True)
    assert features.FlowEncoder.from_json(encoder.to_json()) == encoder


def test_severity_is_graded_on_doubles(spark):
    df = spark.createDataFrame([(0.9,), (0.8999,), (0.7,), (0.69,)], "p double")
    assert [r[0] for r in df.select(scalar.severity(F.col("p"))).collect()] == ["High", "Medium", "Medium", "Low"]


def test_text_to_types(spark):
    df = spark.createDataFrame([("3.0",), ("12",), ("x",), ("NaN",), ("",), (None,)], "t string")
    found = [tuple(r) for r in df.select(scalar.typed(F.col("t"), "int"), scalar.typed(F.col("t"), "float"), scalar.typed(F.col("t"), "category")).collect()]
    assert found == [(3, 3.0, "3.0"), (12, 12.0, "12"), (None, None, "x"), (None, None, None), (None, None, None), (None, None, None)]


def test_json_safe_drops_what_json_lacks(spark):
    df = spark.createDataFrame([(1.0, 2), (math.nan, 3), (math.inf, 4), (None, None)], "x double, n int")
    found = [r[0] for r in df.select(scalar.json_safe("x", df.schema["x"].dataType)).collect()]
    assert found == [1.0, None, None, None]
