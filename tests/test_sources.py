import pytest
from pyspark.sql import functions as F

from flowlake import contract
from flowlake.operators import sampling
from flowlake.plans import marts
from flowlake.session import scratch_path
from flowlake.sources import readers, writers
from flowlake.sources import tables as stored


def test_capture_types_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "capture.csv"
    path.write_text(
        ",Proto,TotPkts,Dur,dDSb,Seq,Attack Type\n"
        "0,tcp,3.0,0.5,NaN,1,Benign\n"
        "1,udp,12,NA,cs0,2,UDPFlood\n"
        "2,,x,1e3,,3,\n"
    )
    df = readers.read_capture(spark, str(path))
    assert dict(df.dtypes) == {
        "Unnamed: 0": "double", "Proto": "string", "TotPkts": "bigint", "Dur": "double", "dDSb": "string",
        "Seq": "double", "Attack Type": "string",
    }
    rows = [tuple(r) for r in contract.drop_contract_columns(df).collect()]
    assert rows == [("tcp", 3, 0.5, None, "Benign"), ("udp", 12, None, "cs0", "UDPFlood"), (None, None, 1000.0, None, None)]


def test_missing_table_is_none(spark, tmp_path):
    assert readers.read_if_present(spark, str(tmp_path / "nothing")) is None


def test_cache_follows_options(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    root = str(tmp_path)
    for engineer in (True, True, False):
        assert readers.load_or_build(spark, root, build, engineer).count() == 5
    assert len(calls) == 2
    assert readers.cache_key(True) != readers.cache_key(False) != readers.cache_key(False, "other")


def test_warehouse_load_appends_truncates_and_skips(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert writers.load_warehouse(df, "wh_load")
    writers.load_warehouse(df.select("v", "k"), "wh_load")  # by name, not by place
    assert [tuple(r) for r in spark.table("wh_load").select("k", "v").collect()] == [("a", 1)] * 2
    assert not writers.load_warehouse(df.limit(0), "wh_load", truncate=True)
    assert not writers.load_warehouse(None, "wh_load", truncate=True)
    assert spark.table("wh_load").count() == 2
    writers.load_warehouse(df, "wh_load", truncate=True)
    assert spark.table("wh_load").count() == 1
    assert spark.table("wh_load").filter("loaded_at IS NULL").count() == 0
    writers.load_warehouse(df, "wh_upper", upper=True)
    assert spark.table("wh_upper").columns == ["K", "V", "LOADED_AT"]


def test_all_tables_can_be_created(spark):
    stored.create_tables(spark)
    for name in stored.TABLES:
        assert spark.catalog.tableExists(name)
    assert spark.table("silver_flows").columns == [*contract.SILVER_COLUMNS, "loaded_at"]


def test_splits_are_read_by_folder(spark, tmp_path):
    split = sampling.stratified_split(spark.range(200).withColumn("k", F.lit("x")), "k", "id")
    writers.save_splits(split, str(tmp_path))
    part = writers.load_split(spark, str(tmp_path), "test")
    assert part.count() == 30 and part.columns == ["id", "k"]
    assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()


def test_staging_view_and_mart_table(spark, flows):
    stored.expose({"stg_view": marts.staging_flows(flows)}, {"mart_protocol": marts.protocol_breakdown(marts.staging_flows(flows))})
    assert spark.table("stg_view").count() == flows.count()
    assert spark.sql("SELECT sum(flow_count) AS n FROM mart_protocol").first()["n"] == flows.count()


def test_unknown_attack_keeps_a_null_category(spark):
    df = spark.createDataFrame([("Mystery",), ("SYNScan",), (None,)], "attack_type string")
    found = {r["attack_type"]: r["attack_category"] for r in marts.with_category(df).collect()}
    assert found == {"Mystery": None, "SYNScan": "Reconnaissance", None: None}


def test_replay_rows_drop_and_flag(spark):
    raw = spark.createDataFrame([(1, "tcp", None, 9.0)], "Seq int, Proto string, dTtl double, Dur double")
    row = writers.prepare_replay(raw).first()
    assert row.asDict() == {"Proto": "tcp", "dTtl": None, "Dur": 9.0, "is_tcp": 1, "has_dst_reply": 0}


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_mart_plans(spark, tables):
    """The flows are shuffled once, as partial counts; only the needed columns are read."""
    plan = marts.attack_summary(tables.staging)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "partial_count" in plan and "partial_sum" in plan
    scan = spark.read.parquet(f"{tables.folder}/lineitem.parquet").filter("l_quantity > 5").groupBy("l_returnflag").count()
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,5.0)]" in text
