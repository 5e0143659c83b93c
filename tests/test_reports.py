"""Header, numbering, identifiers by level, total indicator, publishing order."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rollwright.operators.report import LINE, LevelFormat, ReportFormat, build_report, report_bundle, union_all
from rollwright.plans.reports import ReportPlan, publish_reports, subgroup_reports
from tests.conftest import rows

COLUMNS = ["file_record_number", "state", "lea", "school", "table_name", "grade", "sex", "filler", "total_indicator", "explanation", "Counts"]


def fmt(**changes):
    settings = dict(
        kind="7",
        title="TALLY",
        file_name="ZZ{short}TALLY.csv",
        identifier="N{kind} {short} {period}",
        period="2001-2002",
        columns=COLUMNS,
        levels={
            "school": LevelFormat("SCHOOL", "SCH", {"lea": F.substring("site", 1, 3), "school": F.col("site")}),
            "state": LevelFormat("STATE", "STA", {"lea": "", "school": ""}),
        },
        table_name=F.when(F.col("grade") == "10", F.lit("HIGH")).otherwise(F.lit("LOW")),
        fixed={"state": "99"},
    )
    return ReportFormat(**(settings | changes))


@pytest.fixture()
def people(spark):
    data = [(1, "001001", "03", "F"), (2, "001001", "03", "M"), (3, "002001", "10", "F"), (4, "002001", "10", None)]
    return spark.createDataFrame(data, "id bigint, site string, grade string, sex string")


def test_report_records(spark, people):
    plans = {"7": ReportPlan(people, ["grade"], fmt())}
    reports = subgroup_reports(plans, [[], ["sex"]], {"school": "site", "state": None}, "id")
    school = [tuple(r)[:-1] for r in reports["7", "school"].orderBy(LINE).collect()]
    assert school[0] == ("SCHOOL TALLY", "5", "ZZSCHTALLY.csv", "N7 SCH 2001-2002", "2001-2002", "", "", "", "", "", "")
    assert school[1:] == [
        ("1", "99", "001", "001001", "LOW", "03", "", "", "Y", "", "2"),
        ("2", "99", "001", "001001", "LOW", "03", "F", "", "N", "", "1"),
        ("3", "99", "001", "001001", "LOW", "03", "M", "", "N", "", "1"),
        ("4", "99", "002", "002001", "HIGH", "10", "", "", "Y", "", "2"),
        ("5", "99", "002", "002001", "HIGH", "10", "F", "", "N", "", "1"),
    ]
    state = reports["7", "state"].orderBy(LINE).collect()
    assert [r["Counts"] for r in state] == ["", "2", "1", "1", "2", "1", "0"]
    assert {r["school"] for r in state[1:]} == {""}
    old = subgroup_reports(plans, [[], ["sex"]], {"state": None}, "id", null_only_total=True)
    assert {r["total_indicator"] for r in old["7", "state"].collect()} == {"", "N"}


def test_unknown_level_kind_and_width_are_errors(spark, people):
    counts = people.groupBy("grade").agg(F.count("id").alias("Counts"))
    with pytest.raises(ValueError, match="level"):
        build_report(counts, fmt(), "county", ["grade"])
    with pytest.raises(ValueError, match="format"):
        report_bundle({"8": {"state": counts}}, {"7": fmt()}, {"state": None}, {"8": ["grade"]})
    with pytest.raises(ValueError, match="five"):
        build_report(counts, fmt(columns=["grade", "Counts"]), "state", ["grade"])


def test_published_file_starts_with_the_header(spark, people, tmp_path):
    plans = {"7": ReportPlan(people, ["grade"], fmt())}
    reports = subgroup_reports(plans, [[], ["sex"]], {"school": "site"}, "id")
    paths = publish_reports(reports, str(tmp_path), {("7", "school"): "school_7"})
    parts = sorted(Path(paths["7", "school"]).glob("part-*.csv"))
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert lines[0].startswith("SCHOOL TALLY,5,ZZSCHTALLY.csv")
    assert [line.split(",")[0] for line in lines[1:]] == ["1", "2", "3", "4", "5"]


def test_union_all_matches_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, n int")
    assert rows(union_all(a, b, a)) == [(1, "x")] * 3


def test_reports_of_all_kinds_are_numbered_together(spark):
    from rollwright.operators.report import merged_order, number_reports

    first = spark.createDataFrame([("10", "F", 1), ("03", "M", 2), ("03", "F", 3)], "grade string, sex string, Counts int")
    second = spark.createDataFrame([("001", "b", "F", 4), ("001", "a", "F", 5)], "lea string, status string, sex string, Counts int")
    nothing = second.where("Counts > 9")
    found = number_reports(
        {"A": {"state": first}, "B": {"district": second, "state": nothing.drop("lea")}}, {"state": None, "district": "lea"},
        {"A": ["grade", "sex"], "B": ["status", "sex"]},
    )
    numbered = {key: (rows(table), height.first()[0]) for key, (table, height) in found.items()}
    assert numbered["A", "state"] == ([("03", "F", 3, 1), ("03", "M", 2, 2), ("10", "F", 1, 3)], 3)
    assert numbered["B", "district"] == ([("001", "a", "F", 5, 1), ("001", "b", "F", 4, 2)], 2)
    assert numbered["B", "state"] == ([], 0)
    assert merged_order([["a", "b", "d"], ["a", "c", "d"]]) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="conflicting"):
        merged_order([["a", "b"], ["b", "a"]])
