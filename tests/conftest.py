import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rimeframe.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        builder(
            "tests",
            {
                "spark.sql.shuffle.partitions": "4",
                "spark.ui.enabled": "false",
                "spark.driver.memory": "4g",
                "spark.sql.sources.parallelPartitionDiscovery.parallelism": "4",
            },
        )
        .master("local[4]")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
