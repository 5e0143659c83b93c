from __future__ import annotations

from rollwright.functions import text as X
from tests.conftest import rows

import datetime


def test_labelled_fields(values):
    patterns = {"grade": r"Grade: (.*?)\n", "system": r"System: (.*?)(?:\n|$)"}
    data = [("Grade:  9 \nSystem: X",), ("nothing",), (None,)]
    assert values(data, "t string", *X.extract_labelled_fields("t", patterns)) == [("9", "X"), (None, None), (None, None)]
    kept = X.extract_labelled_fields("t", patterns, empty_as_null=False, trim=False)
    assert values(data, "t string", *kept) == [(" 9 ", "X"), ("", ""), (None, None)]


def test_cut_and_replace(values):
    got = values(
        [("Ann Grade: 9",), ("Ann",), ("",), (None,)], "t string", X.cut_at_marker("t", "Grade:"), X.cut_at_marker("t", ".")
    )
    assert got == [("Ann ", "Ann Grade: 9"), ("Ann", "Ann"), ("", ""), (None, None)]
    replaced = X.replace_chain("t", [("\n", " "), ("SCORE", "")])
    assert values([("SCORE\n 12 ",), ("(a.b)",), (None,)], "t string", replaced) == [("12",), ("(a.b)",), (None,)]


def test_split_to_columns(values):
    data = [("a|b|c",), ("a",), ("",), (None,)]
    assert values(data, "t string", *X.split_to_columns("t", "|", ["x", "y"])) == [
        ("a", "b"), ("a", None), ("", None), (None, None)
    ]
    assert values(data, "t string", *X.split_to_columns("t", "|", ["x", "y"], rest_in_last=True))[0] == ("a", "b|c")
    assert values(data, "t string", *X.split_to_columns("t", "|", ["x", "y", "z"], exact=True)) == [
        ("a", "b", "c"), (None, None, None), (None, None, None), (None, None, None)
    ]


def test_split_name(values):
    data = [("Ann",), ("Ann Lee",), ("Ann B C Lee",), ("Ann  Lee",), (None,)]
    assert values(data, "t string", *X.split_name("t")) == [
        ("Ann", None, "Ann"), ("Ann", None, "Lee"), ("Ann", "B C", "Lee"), ("Ann", None, "Lee"), (None, None, None)
    ]


def test_fixed_matches_flag_other_counts(spark):
    data = [("≥95% 10% NR",), ("1% 2%",), ("1% 2% 3% 4%",), ("",), (None,)]
    df = X.with_fixed_matches(spark.createDataFrame(data, "t string"), "t", r"(≥?≤?\d+%|NR|N/A)", ["a", "b", "c"], "bad")
    assert rows(df.drop("t")) == sorted(
        [("≥95%", "10%", "NR", False)] + [(None, None, None, True)] * 4, key=lambda r: (r[0] is not None,)
    )


def test_dates(values):
    data = [("02/29/2004",), ("02/30/2004",), ("--/--/----",), ("x",), (None,)]
    got = values(data, "t string", *X.parse_date_parts("t", "d", ["--/--/----"]))
    assert got == [(29, 2, 2004)] + [(None, None, None)] * 4
    assert values(data[:1], "t string", X.parse_date("t")) == [(datetime.date(2004, 2, 29),)]
