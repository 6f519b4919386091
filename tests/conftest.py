import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sheafworks.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        8,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluates a column expression over text for a list of inputs."""
    from pyspark.sql import functions as F

    def run(make, inputs):
        rows = [(i, x) for i, x in enumerate(inputs)]
        df = spark.createDataFrame(rows, "i int, x string").select("i", make(F.col("x")).alias("y"))
        return [row["y"] for row in df.orderBy("i").collect()]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
