import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import local_session  # noqa: E402
from emberwall.session import apply_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = apply_settings(local_session(8, "emberwall tests"))
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Make a frame of log lines, one id per line."""

    def make(*texts):
        rows = list(enumerate(texts))
        return spark.createDataFrame(rows, "id long, value string")

    return make


@pytest.fixture
def traffic(spark):
    """Make the columns the detectors use: source, time, length."""

    def make(rows):
        df = spark.createDataFrame(rows, "source_ip string, time string, data_length int")
        return df.selectExpr(
            "monotonically_increasing_id() AS id",
            "source_ip",
            "CAST(time AS timestamp) AS timestamp",
            "data_length",
        )

    return make
