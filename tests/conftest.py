from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from basketflow.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
OBS = "product_id STRING, category STRING, retailer STRING, price DOUBLE, timestamp TIMESTAMP_NTZ"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.showConsoleProgress": "false",
            # Tiny inputs: compiling a stage costs more than running it.
            "spark.sql.codegen.wholeStage": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def observations(spark):
    """Rows (product_id, category, retailer, price, timestamp) as a panel."""

    def build(rows):
        return spark.createDataFrame([(p, c, r, x, t) for p, c, r, x, t in rows], OBS)

    return build


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)
