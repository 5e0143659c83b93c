"""Scalar expressions on rows that hold null, NaN, '' and white space side by side."""

from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollwright.functions import columns as C
from tests.conftest import rows

NAN = float("nan")


def test_strip_removes_all_white_space(values):
    got = values([("\t a b\n",), (" x　",), ("",), (None,), ("  ",)], "s string", C.strip("s"))
    assert got == [("a b",), ("x",), ("",), (None,), ("",)]
    assert values([("\t a ",)], "s string", C.strip("s", blanks_only=True)) == [("\t a",)]


def test_zfill_keeps_long_values(values):
    got = values([("7",), ("12345",), ("",), (None,)], "s string", C.zfill("s", 3))
    assert got == [("007",), ("12345",), ("000",), (None,)]


def test_compose_key_is_null_with_any_null_part(values):
    got = values([("a", "b"), ("a", None), ("", "b")], "x string, y string", C.compose_key("x", "y", sep="_"))
    assert got == [("a_b",), (None,), ("_b",)]


def test_prefix(values):
    got = values([("12345",), ("1",), ("",)], "s string", C.prefix_of("s", 3), C.starts_in("s", ["1"]))
    assert got == [("123", True), ("1", True), ("", False)]


def test_case_map_defaults(values):
    got = values(
        [("a",), ("z",), (None,)],
        "s string",
        C.case_map("s", {"a": "A"}),
        C.case_map("s", {"a": "A"}, None),
        C.case_map("s", {"a": "A"}, "?"),
    )
    assert got == [("A", "A", "A"), ("z", None, "?"), (None, None, "?")]


def test_ordered_rules_first_match_wins(values):
    rule = C.ordered_rules([("n > 1", "big"), ("n > 0", "small"), (F.col("n").isNull(), "unknown")], "none")
    assert values([(2,), (1,), (0,), (None,)], "n int", rule) == [("big",), ("small",), ("none",), ("unknown",)]
    with pytest.raises(ValueError):
        C.ordered_rules([])


def test_any_flag_is_never_null(values):
    data = [("1", None), (None, None), ("0", None), (None, "1"), ("", "0")]
    assert values(data, "a string, b string", C.any_flag(["a", "b"], "1")) == [
        (True,), (False,), (False,), (True,), (False,)
    ]
    assert values([(1, None), (2, "1")], "a int, b string", C.any_flag(["a", "b"], "1", as_text=True)) == [(True,), (True,)]


def test_contains_class_takes_the_first_part(values):
    rule = C.contains_class("s", [("at", 1), ("sea", 0)])
    assert values([("Atlas Sea",), ("SEA",), ("x",), (None,)], "s string", rule) == [(1,), (0,), (None,), (None,)]


def test_all_null_indicator(values):
    got = values([(None, None), ("", None)], "a string, b string", C.all_null_indicator(["a", "b"]))
    assert got == [("Y",), ("N",)]


def test_nan_null_and_blank_stay_apart(values):
    got = values(
        [(NAN,), (None,), (2.9,), (0.0,), (-2.9,)],
        "x double",
        C.nan_to_zero("x"),
        C.number_or_zero("x"),
        C.whole_number_text("x"),
        C.valid_score("x"),
        C.absent_or_zero("x"),
    )
    assert got[0] == (0.0, 0.0, "0", False, False)
    assert got[1] == (None, 0.0, "0", False, True)
    assert got[2] == (2.9, 2.9, "2", True, False)
    assert got[3] == (0.0, 0.0, "0", True, True)
    assert got[4][2] == "-2"
    assert values([(None,), (7,)], "n int", C.text_or_blank("n")) == [("",), ("7",)]
    assert values([("-",), ("x",), (None,)], "s string", C.null_if_placeholder("s", "-")) == [(None,), ("x",), (None,)]


def test_id_normalise_keeps_every_digit(values):
    texts = [(" 12.0 ",), ("9007199254740993",), ("1e3",), ("007\t",), (None,)]
    assert values(texts, "s string", C.id_normalise("s")) == [(12,), (9007199254740993,), (1000,), (7,), (None,)]
    bad = [("x",), ("",), ("1" * 30,)]
    assert values(bad, "s string", C.id_normalise("s", strict=False)) == [(None,), (None,), (None,)]
    for text in ("x", ""):
        with pytest.raises(Exception, match="not an ID"):
            values([(text,)], "s string", C.id_normalise("s"))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=3), min_size=1, max_size=20))
def test_round_half_up_agrees_with_decimal(spark, numbers):
    df = spark.createDataFrame([(float(n),) for n in numbers], "x double")
    got = [r[0] for r in df.select(C.round_half_up("x", 2)).collect()]
    assert got == [float(Decimal(str(float(n))).quantize(Decimal(".01"), rounding=ROUND_HALF_UP)) for n in numbers]


def test_round_worked_examples(values):
    got = values([(1.345,)], "x double", C.round_half_up("x", 2), C.round_half_up("x", 1), C.round_half_up("x"))
    assert got == [(1.35, 1.3, 1.3)]


def test_exact_sum_of_columns(values):
    total = C.exact_sum_of(["a", "b", "c"])
    got = values([(0.1, 0.2, None), (NAN, None, 3.75), (None, None, None)], "a double, b double, c double", total)
    assert got == [(0.3,), (3.75,), (0.0,)]


def by_text(text):
    return F.when(text.isNotNull(), F.raise_error(F.lit("by text")).cast("array<decimal(38,0)>"))


def test_ordinary_numbers_of_a_row_add_without_their_text(values, monkeypatch):
    monkeypatch.setattr(C, "_limb_array", by_text)
    data = [(0.1, 3, Decimal("-0.3000000001")), (NAN, None, None), (-1e13, 2**43, Decimal("9999.5")), (1e-5, -1, Decimal(0)), (-0.0, 0, Decimal(0))]
    got = values(data, "a double, b bigint, c decimal(20,10)", C.exact_sum_of(["a", "b", "c"]))
    assert got == [(2.7999999999,), (0.0,), (float(-(10**13) + 2**43 + Decimal("9999.5")),), (-0.99999,), (0.0,)]
    for odd in (1e-6, 1e14):
        with pytest.raises(Exception, match="by text"):
            values([(odd, None, None)], "a double, b bigint, c decimal(20,10)", C.exact_sum_of(["a", "b", "c"]))


def test_exact_sum_of_columns_of_every_size(spark):
    draw = random.Random(8)
    near = [float(f"{s}{m}e{e}") for e in range(-12, 30) for m in ("1", "9.999999999999998", "1.0000000000000002") for s in "+-"] + [0.0, -0.0, NAN, None]
    kinds = "a double, b double, c float, d bigint, e string"
    data = [
        (draw.choice(near), draw.choice(near), draw.choice([0.1, -2.5, 1e10, NAN, None]), draw.choice([2**63 - 1, -(2**63), 10**14, -7, None]),
         draw.choice(["9999999999999999999.9999999999", "-0.0000000001", "99999999999999.5", None]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(data, kinds).withColumn("e", F.col("e").cast("decimal(38,10)"))
    totals = [C.exact_sum_of(c).alias("".join(c)) for c in (["a"], ["a", "b"], ["c", "a"], ["d", "a"], ["e"], ["a", "b", "c", "d", "e"])]
    got = df.select(*totals, *[F.col(c).cast("string").alias(f"text_{c}") for c in "abcde"]).collect()
    with localcontext() as context:
        context.prec = 200
        for r in got:
            for name in ("a", "ab", "ca", "da", "e", "abcde"):
                texts = [r[f"text_{c}"] for c in name]
                assert r[name] == float(sum((Decimal(t) for t in texts if t not in (None, "NaN")), Decimal(0)))


def test_assemble_date_text(values):
    got = values(
        [("7", "04", "2006"), ("7", "04", "1900"), ("7", None, "2006")],
        "m string, d string, y string",
        C.assemble_date_text("m", "d", "y"),
    )
    assert got == [("7/04/2006",), ("04",), (None,)]


def test_expand_column_list():
    assert C.expand_column_list("x", "y", C.Numbered("S_", 1, 2), "z") == ["x", "y", "S_1", "S_2", "z"]
    assert C.expand_column_list() == []


def test_constant_columns_and_text_cast(spark):
    df = C.add_constant_columns(spark.createDataFrame([(1,)], "n int"), ["e"], {"k": "v"})
    assert rows(df) == [(1, None, "v")]
    assert [t for _, t in C.cast_all_to_string(df).dtypes] == ["string"] * 3


def test_conditional_null_keeps_the_flag(spark):
    df = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "s string, void boolean")
    assert rows(C.conditional_null(df, ["s"], ~F.col("void")), "void", "s") == [(None, None), (False, "b"), (True, None)]


def test_parametric_name_needs_one_value(spark):
    one = spark.createDataFrame([(1, "English")] * 3, "score int, subject string")
    assert C.parametric_name(one, "score", "Score_{}", "subject", {"English": "E"}).columns == ["Score_E", "subject"]
    with pytest.raises(ValueError):
        C.parametric_name(one.unionByName(one.withColumn("subject", F.lit("M"))), "score", "Score_{}", "subject")


def test_nan_is_no_null(values):
    assert math.isnan(values([(NAN,)], "x double", F.col("x"))[0][0])
