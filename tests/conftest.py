import pytest

from flowlake.session import build_session
from tests.compare import connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def con(folder):
    return connect(folder)


@pytest.fixture(scope="session")
def tables(spark, folder):
    from flowlake.registry.core import Tables

    return Tables(spark, folder)


@pytest.fixture(scope="session")
def flows(tables):
    return tables.flows.drop("row_id", "Seq")
