import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from paytally.session import build_session  # noqa: E402
from paytally.sinks import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "paytally-tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "warehouse"), f"test_{uuid.uuid4().hex}")
    yield house
    spark.sql(f"DROP DATABASE IF EXISTS `{house.database}` CASCADE")


@pytest.fixture
def lines(spark):
    def build(*texts):
        return spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)

    return build
