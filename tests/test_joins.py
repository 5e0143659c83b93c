"""Joins and ID sets: null keys, duplicates, IDs above 2^53."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollwright.operators import filters as FL
from rollwright.operators import joins as J
from tests.conftest import rows

BIG = 9007199254740992


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (None, "n"), (BIG, "x"), (BIG + 1, "y")], "id bigint, name string")


@pytest.fixture()
def ids(spark):
    return spark.createDataFrame([(2,), (2,), (None,), (BIG + 1,)], "known bigint")


def test_semi_and_anti_leave_null_keys_out(people, ids):
    assert rows(J.semi_join(people, ids, {"id": "known"}), "name") == [("b",), ("b2",), ("y",)]
    assert rows(J.anti_join(people, ids, {"id": "known"}), "name") == [("a",), ("x",)]


def test_membership_flag_keeps_rows(people, ids):
    got = rows(J.membership_flag(people, ids, {"id": "known"}, "in"), "name", "in")
    assert got == [("a", "N"), ("b", "Y"), ("b2", "Y"), ("n", "N"), ("x", "N"), ("y", "Y")]
    assert rows(J.membership_flag(people, ids, {"id": "known"}, "in", no=None), "in") == [(None,)] * 3 + [("Y",)] * 3


def test_left_enrich_fans_out_or_refuses(spark, people):
    lookup = spark.createDataFrame([(2, "p"), (2, "q"), (None, "z")], "id bigint, more string")
    assert rows(J.left_enrich(people, lookup, "id"), "name", "more") == [
        ("a", None), ("b", "p"), ("b", "q"), ("b2", "p"), ("b2", "q"), ("n", None), ("x", None), ("y", None)
    ]
    with pytest.raises(ValueError, match="duplicate"):
        J.left_enrich(people, lookup, "id", unique=True)
    assert J.inner_join(people, lookup, "id").count() == 4
    assert rows(J.left_then_require(people, lookup, "id", "more"), "name", "more")[0] == ("b", "p")


def test_columns_of_both_sides_keep_apart(spark, people):
    lookup = spark.createDataFrame([(1, "other", "m")], "id bigint, NAME string, more string")
    joined = J.left_enrich(people, lookup, "id")
    assert joined.columns == ["id", "name", "NAME_right", "more"]
    assert rows(joined.where("id = 1")) == [(1, "a", "other", "m")]


def test_full_outer_flags(spark):
    def one(*v):
        return spark.createDataFrame([(x,) for x in v], "id bigint")

    got = J.full_outer_flags({"v1": one(1, 1, 2), "v2": one(2, 3, None), "v3": one()}, "id")
    assert rows(got) == [(1, True, None, None), (2, True, True, None), (3, None, True, None)]


def test_replace_is_one_hop_and_the_latest_wins(spark):
    mapping = spark.createDataFrame(
        [(1, 2, 0), (2, 3, 1), (5, 6, 2), (5, 7, 3), (None, 9, 4), (BIG, 0, 5)], "old bigint, new bigint, seq int"
    )
    df = spark.createDataFrame([(1,), (2,), (5,), (8,), (None,), (BIG,), (BIG + 1,)], "id bigint")
    got = rows(J.replace_by_lookup(df, "id", mapping, "old", "new", "seq"))
    assert got == [(None,), (0,), (2,), (3,), (7,), (8,), (BIG + 1,)]
    with pytest.raises(TypeError):
        J.replace_by_lookup(df.withColumn("id", F.col("id").cast("double")), "id", mapping, "old", "new")


def test_coalesce_key(values):
    got = values([(1, "x"), (None, "x"), (None, None)], "n bigint, s string", J.coalesce_key("n", "s"))
    assert got == [("1",), ("x",), (None,)]


def test_filters_and_null(spark):
    df = spark.createDataFrame([("169", 1), ("X36", 2), (None, 3), ("502", None), ("", 5)], "c string, n int")
    assert rows(FL.filter_gt(df, "c", "169"), "c") == [("502",), ("X36",)]
    assert rows(FL.filter_ne(df, "c", "169"), "c") == [("",), ("502",), ("X36",)]
    assert rows(FL.filter_not_in(df, "c", ["502"]), "n") == [(1,), (2,), (5,)]
    # Unknown inside NOT(...) drops the row, unless another part is false.
    assert rows(FL.filter_not_all(df, "c = 'X36'", "n > 1"), "n") == [(None,), (1,), (5,)]
    assert rows(FL.filter_not_null(df), "n") == [(1,), (2,), (5,)]
    scores = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert rows(FL.filter_valid_score(scores, "x")) == [(1.0,)]


def test_split_covers_and_does_not_overlap(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    parts = FL.partition_split(df, {"low": "n < 2", "high": "n >= 2"})
    assert {k: rows(v) for k, v in parts.items()} == {"low": [(1,)], "high": [(2,)]}
    assert rows(FL.label_parts(df, {"low": "n < 2", "high": "n >= 2"})) == [(1, "low"), (2, "high")]
    assert rows(FL.allowed_combinations(df, [{"n": [2]}])) == [(2,)]


def test_latest_mapping_is_settled_for_ties_and_unknown_orders(spark):
    mapping = spark.createDataFrame([("k", "a", 1), ("k", "b", 1), ("k", "z", None), ("n", "c", None)], "old string, new string, seq int")
    assert rows(J.latest_mapping(mapping, "old", "new", "seq")) == [("k", "b"), ("n", "c")]
