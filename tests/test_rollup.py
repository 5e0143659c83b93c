"""Rollups: nulls in used keys, '' for unused ones, zero-filled cells."""

from __future__ import annotations

import random
import re
from decimal import Decimal, localcontext
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollwright.functions import columns as C
from rollwright.operators import rollup as R
from tests.conftest import rows

SETS = [[], ["sex"], ["race"], ["sex", "race"]]
SCHEMA = "id bigint, site string, grade string, sex string, race string"

PEOPLE = [
    (1, "001001", "03", "F", "A"),
    (2, "001001", "03", "M", "A"),
    (3, "001002", "03", "F", None),
    (None, "001002", "10", "M", "B"),
    (5, "002001", None, "F", "B"),
    (6, "002001", "10", "", "A"),
]


def naive(people, entity, sets):
    """Count set by set with plain Python."""
    counts: dict[tuple, int] = {}
    for used in sets:
        for pid, site, grade, sex, race in people:
            shown = [sex if "sex" in used else "", race if "race" in used else ""]
            key = [*([entity(site)] if entity else []), grade, *shown]
            if None in key:
                continue
            key = (*key, len(used) == 0, tuple(used))
            counts[key] = counts.get(key, 0) + (pid is not None)
    return sorted((*k[:-2], n, k[-2]) for k, n in counts.items())


def rolled(df):
    return sorted(tuple(r) for r in df.collect())


def test_null_in_a_used_key_drops_for_that_set_only(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    got = R.subgroup_rollup(df, ["site", "grade"], SETS, "id", total_flag="total")
    assert rolled(got) == naive(PEOPLE, lambda s: s, SETS)
    # The row without a race counts in the sets that do not use it.
    assert ("001002", "03", "F", "", 1, False) in rolled(got)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 9)),
            st.sampled_from(["001001", "001002", "002001"]),
            st.sampled_from(["03", "10", None]),
            st.sampled_from(["F", "M", None, ""]),
            st.sampled_from(["A", "B", None]),
        ),
        max_size=30,
    )
)
def test_rollup_equals_the_naive_union(spark, people):
    df = spark.createDataFrame(people, SCHEMA)
    assert rolled(R.subgroup_rollup(df, ["grade"], SETS, "id", total_flag="total")) == naive(people, None, SETS)


def test_total_of_a_set_equals_the_filtered_count(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    got = R.subgroup_rollup(df, ["grade"], [["race"]], "id").agg(F.sum("Counts")).first()[0]
    assert got == df.where("grade IS NOT NULL AND race IS NOT NULL").agg(F.count("id")).first()[0]


def test_a_set_listed_twice_is_counted_twice(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    assert rolled(R.subgroup_rollup(df, ["grade"], [["sex"], ["sex"]], "id")) == sorted(
        2 * rolled(R.subgroup_rollup(df, ["grade"], [["sex"]], "id"))
    )
    assert rolled(R.zero_filled_counts(df, ["grade"], [["sex"], ["sex"]], "id")) == sorted(
        2 * rolled(R.zero_filled_counts(df, ["grade"], [["sex"]], "id"))
    )


def test_zero_filled_shows_every_combination(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    sets = [["race"], ["sex", "race"], []]
    got = rolled(R.zero_filled_counts(df, ["grade"], sets, "id", total_flag="total"))
    grades, sexes, races = ["03", "10"], ["", "F", "M"], ["A", "B"]
    assert len(got) == len(grades) * (1 + len(races) + len(sexes) * len(races))
    counted = {r[:3] + (r[4],): r[3] for r in naive(PEOPLE, None, sets)}
    shown = [c if i else c for i, c in enumerate(df.columns)]
    assert "race" in shown
    for grade, race, sex, n, total in got:
        if not (sex == "" and race):  # '' is both a value of sex and "unused"
            assert n == counted.get((grade, sex, race, total), 0)


def test_allowed_and_given_domains(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    got = R.zero_filled_counts(
        df, ["grade"], [["race"]], "id", domains={"race": ["A", "B", "C"]}, allowed=[{"grade": ["03"], "race": ["A", "C"]}]
    )
    assert rolled(got) == [("03", "A", 2), ("03", "C", 0)]


def test_scaffold_is_the_product_of_the_domains(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    got = {(r["grade"], r["race"]) for r in R.cross_scaffold(df, ["grade", "race"]).collect()}
    assert got == set(product(["03", "10"], ["A", "B"]))


def test_levels_agree_with_single_rollups(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA).withColumn("lea", F.substring("site", 1, 3))
    levels = {"school": "site", "district": "lea", "state": None}
    tables = R.multi_level_rollup(df, ["grade"], SETS, "id", levels, total_flag="total")
    assert rolled(tables["school"]) == naive(PEOPLE, lambda s: s, SETS)
    assert rolled(tables["district"]) == naive(PEOPLE, lambda s: s[:3], SETS)
    assert rolled(tables["state"]) == rolled(R.zero_filled_counts(df, ["grade"], SETS, "id", total_flag="total"))


def test_small_aggregates(spark):
    df = spark.createDataFrame([(0.0,), (float("nan"),), (None,), (3.75,), (0.1,), (0.2,)], "x double")
    assert df.agg(R.exact_sum("x")).first()[0] == 4.05
    assert df.where("x > 9 AND NOT isnan(x)").agg(R.exact_sum("x")).first()[0] == 0.0
    assert R.table_height(df).first()[0] == 6
    text = spark.createDataFrame([("é",), ("ab",), (None,)], "s string")
    assert R.max_length(text, "s").first()[0] == 2 and R.max_length(text.where("s = 'é'"), "s", True).first()[0] == 2
    assert rows(R.distinct_values(text.unionAll(text), "s")) == [(None,), ("ab",), ("é",)]
    assert rows(R.group_count(spark.createDataFrame([(None, "a"), (1, "a"), (None, None)], "id int, k string"), ["k"], "id")) == [
        (None, 0), ("a", 1)
    ]


def test_set_ids_match_grouping():
    assert R._set_ids([["a"], ["b"], [], ["a", "b"]], ["a", "b"]) == [1, 2, 3, 0]


@pytest.mark.parametrize("sets", [[["b"], ["a", "b"]], [["a", "c"], ["b"]], [["c"], ["a"], ["b", "c"]]])
def test_set_order_does_not_change_zero_filled_counts(spark, sets):
    data = [(i, "g", *"xyz") for i in range(3)] + [(9, "g", "x", "q", None)]
    df = spark.createDataFrame(data, "id bigint, g string, a string, b string, c string")
    got = {tuple(sorted(r.asDict().items())) for r in R.zero_filled_counts(df, ["g"], sets, "id").where("Counts > 0").collect()}
    want = {tuple(sorted(r.asDict().items())) for r in R.subgroup_rollup(df, ["g"], sets, "id").where("Counts > 0").collect()}
    assert got == want and got


def test_corner_sets(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    assert rolled(R.subgroup_rollup(df, ["grade"], [[]], "id", total_flag="t")) == [("03", 3, True), ("10", 1, True)]
    assert rolled(R.zero_filled_counts(df, ["grade"], [[]], "id", total_flag="t")) == [("03", 3, True), ("10", 1, True)]
    assert rolled(R.subgroup_rollup(df, [], [[], ["race"]], "id")) == [("", 5), ("A", 3), ("B", 1)]
    assert rolled(R.zero_filled_counts(df, [], [[], ["race"]], "id")) == [("", 5), ("A", 3), ("B", 1)]
    assert rolled(R.zero_filled_counts(df.where("id > 99"), ["grade"], [["race"]], "id")) == []
    assert rolled(R.subgroup_rollup(df.where("id > 99"), ["grade"], [["race"]], "id")) == []


def test_exact_sum_keeps_every_digit_or_raises(spark):
    df = spark.createDataFrame([(0.0000004,)] * 10 + [(33.123456789,)], "x double")
    assert df.agg(R.exact_sum("x")).first()[0] == 33.123460789
    with pytest.raises(Exception, match="too many digits"):
        spark.createDataFrame([(1e-60,)], "x double").agg(R.exact_sum("x")).collect()


def test_exact_sum_of_every_type(spark):
    draw = random.Random(4)
    data = [
        (draw.randrange(-(2**63), 2**63), f"{draw.randrange(-10**27, 10**27)}.{draw.randrange(10**10):010}", draw.choice([1, -1]) * draw.random() * 10.0 ** draw.randrange(-18, 37))
        for _ in range(400)
    ] + [(None, None, None), (None, None, float("nan")), (0, "-0.0000000001", 0.0)]
    df = spark.createDataFrame(data, "a bigint, b string, c double").withColumn("b", F.col("b").cast("decimal(38,10)"))
    got = df.agg(*[R.exact_sum(c, "string").alias(c) for c in "abc"], *[R.exact_sum(c).alias(c + "2") for c in "abc"]).first()
    texts = df.select(*[F.col(c).cast("string") for c in "abc"]).collect()
    with localcontext() as context:
        context.prec = 200
        for i, c in enumerate("abc"):
            want = sum((Decimal(r[i]) for r in texts if r[i] not in (None, "NaN")), Decimal(0))
            assert Decimal(got[c]) == want and got[c + "2"] == float(want)


def test_exact_sum_by_result_type(spark):
    df = spark.createDataFrame([(9007199254740993, "12345678901234567.1234567891"), (-9007199254740992, "-12345678901234567")], "a bigint, t string")
    df = df.withColumn("b", F.col("t").cast("decimal(38,10)"))
    assert df.agg(R.exact_sum("a"), R.exact_sum("b", "decimal(38,10)")).first() == (1.0, Decimal("0.1234567891"))
    assert df.where("a = 0").agg(R.exact_sum("a", "decimal(38,0)"), R.exact_sum("b", "string")).first() == (Decimal(0), "0")
    with pytest.raises(Exception, match="cannot hold the sum"):
        df.agg(R.exact_sum("b", "decimal(38,2)")).collect()
    with pytest.raises(Exception, match="too many digits"):
        spark.createDataFrame([(float("inf"),)], "x double").agg(R.exact_sum("x")).collect()


def test_ordinary_numbers_sum_without_their_text(spark, monkeypatch):
    stop = F.raise_error(F.lit("by text")).cast("array<decimal(38,0)>")
    monkeypatch.setattr(C, "_limb_array", lambda text: F.when(text.isNotNull(), stop))
    data = [("x", 0.1, 7, "-0.0000000003"), ("x", 123456.789, None, "12.5"), ("x", float("nan"), -9, None), ("x", 1e12, 0, "0"), ("y", None, None, None), ("y", -0.0, None, None)]
    df = spark.createDataFrame(data, "k string, a double, b int, t string").withColumn("c", F.col("t").cast("decimal(38,10)"))
    got = rows(df.groupBy("k").agg(*[R.exact_sum(c).alias(c) for c in "abc"]))
    assert got == [("x", 1000000123456.889, -2.0, 12.4999999997), ("y", 0.0, 0.0, 0.0)]
    with pytest.raises(Exception, match="by text"):
        spark.createDataFrame([(1e-6,)], "a double").agg(R.exact_sum("a")).collect()


def test_exact_sum_over_sizes_and_groups(spark):
    draw = random.Random(9)
    data = [
        (i % 12, draw.choice([1, -1]) * draw.random() * 10.0 ** draw.randrange(-7, 4 + i % 23), draw.choice([0.1, -3.5, None]), draw.randrange(-(10**28), 10**28), draw.randrange(-(2**63), 2**63))
        for i in range(600)
    ]
    df = spark.createDataFrame([(k, a, f, f"{d / 10**9:.9f}" if k % 2 else "-1.25", n) for k, a, f, d, n in data], "k int, a double, f float, t string, n bigint")
    df = df.withColumn("d", F.col("t").cast("decimal(38,9)")).drop("t")
    got = df.groupBy("k").agg(*[R.exact_sum(c).alias(c) for c in "afdn"], R.exact_sum("d", "string").alias("text")).collect()
    texts = df.select("k", *[F.col(c).cast("string") for c in "afdn"]).collect()
    with localcontext() as context:
        context.prec = 200
        for r in got:
            for c in "afdn":
                want = sum((Decimal(t[c]) for t in texts if t["k"] == r["k"] and t[c] is not None), Decimal(0))
                assert r[c] == float(want) and (c != "d" or Decimal(r["text"]) == want)


def test_exact_sum_is_compiled_with_its_aggregation(spark):
    data = [("x", 0.1, 7, "-0.0000000003", 0.25), ("x", 1e-7, None, "9" * 28 + ".5", -3.5), ("y", None, None, None, None)]
    df = spark.createDataFrame(data, "k string, a double, b bigint, t string, f float").withColumn("c", F.col("t").cast("decimal(38,10)"))
    totals = df.groupBy("k").agg(*[R.exact_sum(c, "string").alias(c) for c in "abcf"])
    assert sorted(tuple(r) for r in totals.collect()) == [("x", "0.1000001", "7", "9" * 28 + ".4999999997", "-3.25"), ("y", "0", "0", "0", "0")]
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"\*\(\d+\) HashAggregate\(keys=\[k#\d+\], functions=\[partial_sum", plan)


def test_exact_sum_of_decimals_around_the_cut(spark):
    near = [f"{s}{w}{p}" for s in ("", "-") for w in ("0", "1", "9" * 17, "9" * 18, "1" + "0" * 18, "9" * 19, "1" + "0" * 19) for p in ("", ".5", ".4999999999", ".9999999999", ".0000000001")]
    small = [f"{s}{p}" for s in ("", "-") for p in ("0.5", "0." + "9" * 18, "7." + "0" * 17 + "1", "0." + "4" * 18)]
    data = [(i % 4, near[i % len(near)], small[i % len(small)], str(Decimal(small[i % len(small)]) * 10**18)) for i in range(3 * len(near))]
    df = spark.createDataFrame(data, "k int, t string, u string, v string")
    df = df.select("k", F.col("t").cast("decimal(38,10)").alias("t"), F.col("u").cast("decimal(38,18)").alias("u"), F.col("u").cast("decimal(30,19)").alias("w"), F.col("v").cast("decimal(38,0)").alias("v"))
    got = df.groupBy("k").agg(*[R.exact_sum(c, "string").alias(c) for c in "tuwv"]).collect()
    texts = df.select("k", *[F.col(c).cast("string") for c in "tuwv"]).collect()
    with localcontext() as context:
        context.prec = 200
        for r in got:
            for c in "tuwv":
                assert Decimal(r[c]) == sum((Decimal(t[c]) for t in texts if t["k"] == r["k"]), Decimal(0))


def test_numbers_by_their_text(spark):
    good = ["1E37", "-1.5E-37", "0.0", "-0.00", "000123.4500", ".5", "7.", "0E-10", "9" * 38 + "." + "9" * 38, "-1.7976E20", "12345678901234567890", "1.0E-3", "NaN", None]
    df = spark.createDataFrame([(t,) for t in good], "t string")
    with localcontext() as context:
        context.prec = 200
        want = sum((Decimal(t) for t in good if t not in (None, "NaN")), Decimal(0))
    assert Decimal(df.agg(R.exact_sum("t", "string")).first()[0]) == want
    for bad in ("1E38", "1.0E308", "1.5E-38", "4.9E-324", "1" + "0" * 38, "0." + "0" * 38 + "1", "Infinity", "-Infinity", "abc"):
        with pytest.raises(Exception, match="too many digits"):
            spark.createDataFrame([(bad,)], "t string").agg(R.exact_sum("t", "string")).collect()


def test_cells_come_from_a_range_and_dictionaries(spark):
    df = spark.createDataFrame(PEOPLE, SCHEMA)
    cells = R.cross_scaffold(df, ["grade"], SETS, allowed=[{"grade": ["03"]}, {"race": ["", "B"], "grade": ["03", "10"]}])
    shape = cells._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in shape and "Generate" not in shape and "Range" in shape and "Aggregate" not in shape
    # Only legal cells are made: 03 with 1 + 3 + 2 + 6 of sex and race, 10 with 1 + 3 + 1 + 3, and 03 with B or '' again.
    assert re.search(r"Range \(0, (\d+)", shape)[1] == str(12 + 2 * (1 + 3 + 1 + 3))
    got = rolled(cells.drop("__set"))
    sexes, races = ["", "F", "M"], ["A", "B"]
    legal = [(g, s, r) for g in ("03", "10") for used in SETS for s in (sexes if "sex" in used else [""]) for r in (races if "race" in used else [""])]
    assert got == sorted(c for c in legal if c[0] == "03" or c[2] in ("", "B"))


def test_views_and_kinds_are_counted_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "people")
    spark.createDataFrame(PEOPLE, SCHEMA).withColumn("lea", F.substring("site", 1, 3)).write.parquet(path)
    df = spark.read.parquet(path)
    kinds = {"K1": ["grade"], "K2": ["site"]}
    levels = {"district": "lea", "state": None}
    views = {"K2": F.col("sex") == "F"}
    tables = R.rollup_of_views(df, kinds, SETS, "id", levels, views, total_flag="total")
    alone = R.multi_level_rollup(df, ["grade"], SETS, "id", levels, total_flag="total")
    women = R.multi_level_rollup(df.where("sex = 'F'"), ["site"], SETS, "id", levels, total_flag="total")
    for level in levels:
        assert rolled(tables["K1"][level]) == rolled(alone[level])
        assert rolled(tables["K2"][level]) == rolled(women[level])
        # The facts are read by the finest counts alone, which are written.
        assert path not in tables["K1"][level]._jdf.queryExecution().optimizedPlan().toString()
        assert not any(path in f for f in tables["K2"][level].inputFiles())
    twice = R.rollup_of_views(df, {"K": ["grade"]}, [["sex"], ["sex"]], "id", levels)["K"]
    once = R.rollup_of_views(df, {"K": ["grade"]}, [["sex"]], "id", levels)["K"]
    assert all(rolled(twice[level]) == sorted(2 * rolled(once[level])) for level in levels)
    with pytest.raises(ValueError, match="basic column of another"):
        R.rollup_of_views(df, {"K1": ["grade"], "K2": ["sex"]}, SETS, "id", levels)


def test_rules_on_basic_columns_come_before_the_subgroups(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, s string")
    cells = R.cross_scaffold(df, ["k"], [[], ["s"]], allowed=[{"k": ["a"], "s": ["", "x"]}])
    assert sorted((r.k, r.s) for r in cells.collect()) == [("a", ""), ("a", "x")]
    either = R.cross_scaffold(df, ["k"], [[], ["s"]], allowed=[{"k": ["a"]}, {"s": ["y"]}])
    assert sorted((r.k, r.s) for r in either.collect()) == [("a", ""), ("a", "x"), ("a", "y"), ("b", "y")]
