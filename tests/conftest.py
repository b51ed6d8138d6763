import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from marketpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "marketpulse-tests",
        {
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
