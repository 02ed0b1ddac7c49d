import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from glossmill.session import build, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = build("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
