from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeloom.plans.star import GIVEN_TABLES, Star  # noqa: E402
from lakeloom.session import get_spark  # noqa: E402
from lakeloom.sources.standins import Extracts  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return Star(Extracts(spark, FOLDER), GIVEN_TABLES)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


def plan_text(df) -> str:
    return df._jdf.queryExecution().toString()
