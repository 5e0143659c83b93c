"""COVERAGE.md names functions and queries that exist, and every query."""

from __future__ import annotations

import re
from pathlib import Path

import __spark_entry__ as entry
from catalogue import registry

ROOT = Path(__file__).resolve().parents[1]


def test_coverage_table_is_true():
    named = set()
    for line in (ROOT / "COVERAGE.md").read_text().splitlines():
        cells = [c.strip() for c in line.strip("|").split("|")]
        if len(cells) != 3 or not re.match(r"[A-Z]\d", cells[0]):
            continue
        for part in cells[1].split(";"):
            module, *functions = re.findall(r"`([^`]+)`", part)
            source = (ROOT / "rollwright" / module).read_text()
            for function in functions:
                assert f"def {function}(" in source, (module, function)
        named |= {q.strip() for q in cells[2].split(",")}
    assert named == set(registry.QUERIES) <= set(entry.queries())
