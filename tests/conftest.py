import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fichario.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app="tests", master="local[8]",
        **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Values of a column expression over rows of the given texts."""

    def run(expression, values, schema="x string"):
        from pyspark.sql import functions as F

        if callable(expression) and not hasattr(expression, "alias"):
            expression = expression(F.col("x"))
        rows = [v if isinstance(v, tuple) else (v,) for v in values]
        indexed = spark.createDataFrame(
            [(n, *r) for n, r in enumerate(rows)], "n int, " + schema
        )
        return [r.y for r in indexed.select("n", expression.alias("y")).orderBy("n").collect()]

    return run
