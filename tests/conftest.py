from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from pagelode.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "pagelode-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Evaluates a column function over values, in order."""

    def run(function, *values):
        rows = spark.createDataFrame(
            [(i, v) for i, v in enumerate(values)], "i INT, v STRING"
        )
        from pyspark.sql import functions as F

        return [r.x for r in rows.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]

    return run
