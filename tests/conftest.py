import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 4, **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame from a schema string and tuples; timestamps are given as text in ``ts:`` columns."""
    def make(schema: str, data: list[tuple]):
        plain = schema.replace("timestamp", "string")
        df = spark.createDataFrame(data, plain)
        names = [p.split()[0] for p in schema.split(",") if p.split()[1] == "timestamp"]
        for name in names:
            df = df.withColumn(name, df[name].cast("timestamp_ntz"))
        return df
    return make
