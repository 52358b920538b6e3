from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests",
        {
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(warehouse),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """Frame of text columns from rows of text or None."""

    def make(columns: str, rows: list[tuple]):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))

    return make


@pytest.fixture
def plan_of():
    """Text of the plan Spark intends to run."""

    def text(df) -> str:
        import contextlib
        import io

        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        return out.getvalue()

    return text
