from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rollwright.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def values(spark):
    """Evaluate column expressions over hand-written rows: values(rows, schema, *columns)."""

    def run(rows, schema, *columns):
        return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]

    return run


def rows(df, *order):
    """Rows as plain tuples in a repeatable order."""
    out = [tuple(r) for r in df.select(*(order or df.columns)).collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
