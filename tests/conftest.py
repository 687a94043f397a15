import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"}
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A one-column table of texts with their number."""

    def make(texts, name="text"):
        return spark.createDataFrame(list(enumerate(texts)), f"i int, {name} string")

    return make
