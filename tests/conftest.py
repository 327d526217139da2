from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faremill.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        shuffle_partitions=8,
        extra={
            "spark.checkpoint.dir": str(shared),
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "2000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(tmp_path):
    """A place for one test's tables."""
    return str(tmp_path)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df) -> list[tuple]:
    """All rows, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def final_plan(df) -> str:
    """The plan AQE ended with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
