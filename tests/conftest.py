import os
import sys
import time

import pytest

os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "newsloom-tests", "local[*]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """The value of a text expression for each of the given texts."""
    def run(fn, *texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        from pyspark.sql import functions as F
        return [r[0] for r in rows.orderBy("i").select(fn(F.col("t"))).collect()]
    return run


@pytest.fixture
def messages(spark):
    """Messages from ``(id, text, time, channel, platform)`` tuples; links empty."""
    from pyspark.sql import functions as F

    def make(*rows):
        df = spark.createDataFrame(
            list(rows), "id string, text string, t string, channel_id string, platform string")
        return df.select(
            "id", "text", F.col("t").cast("timestamp").alias("timestamp"),
            F.lit("a").alias("author"), "channel_id", "platform",
            F.array().cast("array<string>").alias("links"))
    return make
