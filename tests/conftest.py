import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stridebase.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    from stridebase.plans.warehouse import order_warehouse

    return order_warehouse(spark, SF_DIR)


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """A folder for the files of one test run."""
    return str(tmp_path_factory.mktemp("stridebase"))
