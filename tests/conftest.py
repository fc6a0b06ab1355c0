import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pyspark.sql import SparkSession  # noqa: E402

# Started here because test modules build Column constants when they are imported.
SESSION = (
    SparkSession.builder.master("local[8]").appName("tests")
    .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoints-"))
    .config("spark.ui.showConsoleProgress", "false").getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION
