from __future__ import annotations

import pytest

from throngcast.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.driver.memory": "4g",
    }
    session = build_session("throngcast-tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from dicts under a DDL schema."""

    def build(schema: str, *values: tuple):
        return spark.createDataFrame(list(values), schema)

    return build


@pytest.fixture
def evaluate(spark):
    """Value of a column that depends on no input."""

    def run(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return run
