import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from murmur.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "murmur-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one row of inputs."""

    def run(expression, **inputs):
        schema = ", ".join(
            f"{n} {'string' if isinstance(v, str) or v is None else 'bigint' if isinstance(v, int) else 'double'}"
            for n, v in inputs.items()
        )
        frame = spark.createDataFrame([tuple(inputs.values())], schema)
        return frame.select(expression).collect()[0][0]

    return run
