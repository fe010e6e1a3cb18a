import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arbolytics.session import build_session, staging  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[8]", {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"}, shared=str(shared))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def scope(spark):
    """What a test stages goes when it ends; nothing is left in the shared folder."""
    with staging(spark) as folder:
        yield folder
    assert not os.path.exists(folder)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
