import datetime as dt

import pytest

from listing_lake.session import build_session
from listing_lake.sources.lake import Lake


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    return Lake(spark, str(tmp_path))


@pytest.fixture
def now():
    return dt.datetime(2025, 6, 1, tzinfo=dt.timezone.utc)
