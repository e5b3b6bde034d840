import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "shelfwise-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def eav(spark):
    """Builds a long table from (product_id, kind, ord, key, value) tuples."""
    def build(*rows):
        return spark.createDataFrame(list(rows), "product_id long, kind string, ord long, key string, value string")

    return build


@pytest.fixture
def pairs():
    """(key, value) of each row in ord order."""
    def read(df):
        return [(r.key, r.value) for r in df.orderBy("product_id", "kind", "ord").collect()]

    return read


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
