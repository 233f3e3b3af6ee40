import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tunewright.session import build_session, ship_package

    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.log.level": "ERROR",
        },
    )
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return SMALL


@pytest.fixture
def plan():
    """The physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
