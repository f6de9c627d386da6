import pytest
from pyspark.sql import types as T

from flowlake import contract


def test_sizes():
    assert len(contract.FEATURES) == 39
    assert len(contract.CATEGORICAL) == 5
    assert sum(f.nullable for f in contract.FEATURES) == 14
    assert len(contract.raw_columns()) == 52
    assert len(contract.SILVER_COLUMNS) == 47


def test_schemas_follow_the_contract():
    flow = contract.flow_schema()
    assert flow["TotPkts"].dataType == T.LongType() and not flow["TotPkts"].nullable
    assert flow["dTtl"].dataType == T.DoubleType() and flow["dTtl"].nullable
    assert flow["sDSb"].dataType == T.StringType()
    assert "Attack Type" in flow.fieldNames()
    assert contract.silver_schema()["ingestion_timestamp"].dataType == T.TimestampType()
    assert [f.name for f in contract.event_schema()] == ["event_id", "ingestion_timestamp", "schema_version", "flow"]


def test_ddl_marks_required_columns():
    ddl = contract.table_ddl("t")
    assert "`Dur` DOUBLE NOT NULL" in ddl and "`dTtl` DOUBLE,\n" in ddl and "`TotPkts` BIGINT NOT NULL" in ddl


def test_drop_columns_strict_or_not(spark):
    df = spark.createDataFrame([(1, 2.0)], "Seq int, Dur double")
    assert contract.drop_contract_columns(df).columns == ["Dur"]
    with pytest.raises(ValueError):
        contract.drop_contract_columns(df, strict=True)


def test_case_goes_back_to_the_contract(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "TOTPKTS int, smeanpktsz double, Other string")
    assert contract.contract_case(df).columns == ["TotPkts", "sMeanPktSz", "Other"]


def test_ids_and_stamps_are_no_features(spark):
    df = spark.createDataFrame([("e", 1.0, "B", 1)], "EVENT_ID string, Dur double, attack_type string, is_tcp int")
    assert contract.feature_columns(df) == ["Dur", "is_tcp"]


def test_common_columns(spark):
    left = spark.createDataFrame([(1, "a", 2.0)], "a int, b string, c double")
    right = spark.createDataFrame([("a", 2.0, 1)], "b string, c double, d int")
    assert contract.common_columns(left, right) == ["b", "c"]
    assert contract.common_columns(left, right, numeric_only=True) == ["c"]


def test_seed_covers_all_types():
    assert set(contract.ATTACK_CATEGORIES) == set(contract.ATTACK_TYPES)


def test_staging_sql_equals_projection(spark, flows):
    flows.createOrReplaceTempView("silver_for_staging")
    by_sql = spark.sql(contract.staging_sql("silver_for_staging"))
    by_columns = flows.select(contract.staging_columns())
    assert by_sql.columns == by_columns.columns
    assert by_sql.exceptAll(by_columns).count() == 0
    assert all(name == name.lower() for name in by_sql.columns)
