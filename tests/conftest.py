import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kerbside.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield configure(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows as sorted tuples."""

    def collect(df, *cols):
        return sorted(map(tuple, df.select(*(cols or df.columns)).collect()), key=repr)

    return collect
