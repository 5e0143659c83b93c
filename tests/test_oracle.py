"""Every registered query against its SQL, on the smallest given tables; and the shape of its plan."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from catalogue import registry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = ({n: x for n, x in found.items() if n in registry.QUERIES} for found in (entry.queries(), entry.oracle_sql()))

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare(df, con, ORACLES[name]) is None
    shape = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "Scan ExistingRDD"):
        assert node not in shape


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "split", "School_Name", "site_code", "last_name", "person_id", "Birth_Date", "score_composite", "district_pay"
    ]
    assert df.count() > 0
