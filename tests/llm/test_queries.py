"""The registered queries: all there, and those with SQL agree with it."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the given tables are not here")


def test_one_query_for_each_operator():
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", name) for name in corpus_pipeline.QUERIES) if m)
    assert numbers == list(range(1, 14)) and set(corpus_pipeline.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(corpus_pipeline.ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF_DIR), connect(SF_DIR), corpus_pipeline.ORACLES[name]) is None


def test_pipeline_packs_what_the_stages_keep(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    held: dict[int, int] = {}
    for r in rows:
        held[r["sequence_id"]] = held.get(r["sequence_id"], 0) + r["length"]
    assert rows and max(held.values()) <= 2048
