import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scoutline.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoints")
        .config("spark.sql.warehouse.dir", f"file://{shared}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of a column function over a list of texts, in order."""

    def run(function, values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        from pyspark.sql import functions as F

        return [r["out"] for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
