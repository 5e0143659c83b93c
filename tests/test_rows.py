"""One row for each key, order, numbering."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollwright.operators import dedupe as D
from rollwright.operators.numbering import record_number
from tests.conftest import rows

NAN = float("nan")


def gathered(df, order, within=()):
    """The same numbers by one global window: right, but all in one task."""
    window = Window.partitionBy(*within).orderBy(*[F.asc_nulls_first(c) for c in order], F.xxhash64(*df.columns))
    return df.withColumn("n", F.row_number().over(window))


def test_best_row_takes_nulls_first_then_the_tiebreak(spark):
    data = [("a", 1.0, 3), ("a", None, 4), ("b", 2.0, 9), ("b", 2.0, 5), ("c", NAN, 1), ("c", 7.0, 2), (None, 1.0, 1)]
    df = spark.createDataFrame(data, "k string, s double, t int")
    assert rows(D.best_row_per_key(df, ["k"], ["s"], ["t"]), "k", "t") == [(None, 1), ("a", 4), ("b", 5), ("c", 1)]


def test_first_row_ascends_with_nulls_first(spark):
    df = spark.createDataFrame([("a", "y", 1), ("a", None, 2), ("b", "x", 3), ("b", "w", 4)], "k string, s string, t int")
    assert rows(D.first_row_per_key(df, ["k"], ["s", "t"]), "k", "t") == [("a", 2), ("b", 4)]


def test_sort_puts_nulls_first_both_ways(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "n int")
    assert [r[0] for r in D.sort_rows(df, ["n"]).collect()] == [None, 1, 2]
    assert [r[0] for r in D.sort_rows(df, ["n"], reverse=True).collect()] == [None, 2, 1]


@pytest.mark.parametrize("partitions", [1, 7])
def test_record_number_runs_without_gaps_in_order(spark, partitions):
    # A third of all rows shares the leading key.
    df = spark.range(0, 3000, 1, partitions).select(
        F.when(F.col("id") % 3 != 0, (F.col("id") * 7919) % 500).alias("lead"), F.reverse(F.col("id").cast("string")).alias("text"), "id"
    )
    got = record_number(df, ["lead", "text", "id"], "n").collect()
    expected = sorted(
        ((r["lead"], r["text"], r["id"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    )
    assert [(r["lead"], r["text"], r["id"]) for r in sorted(got, key=lambda r: r["n"])] == expected
    assert sorted(r["n"] for r in got) == list(range(1, 3001))
    assert rows(gathered(df, ["lead", "text", "id"])) == rows(record_number(df, ["lead", "text", "id"], "n"))


def test_record_number_of_equal_rows_is_still_gapless(spark):
    df = spark.range(0, 400, 1, 5).select(F.lit("same").alias("s"))
    assert [r[0] for r in rows(record_number(df, ["s"], "n"), "n")] == list(range(1, 401))


def test_copies_are_cut_into_pieces(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = record_number(spark.range(0, 4000, 1, 8).select(F.lit("same").alias("s")), ["s"], "n")
        sizes = [spark.read.parquet(f).count() for f in set(got.inputFiles())]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_numbers_start_anew_within_a_group(spark):
    df = spark.range(0, 2000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") % 50 == 1, F.lit("b")).alias("g"), (-F.col("id")).alias("v")
    )
    got = rows(record_number(df, ["v"], "n", within=["g"]))
    assert got == rows(gathered(df, ["v"], within=["g"]))
    for group in ("a", "b", None):
        assert sorted(n for g, _, n in got if g == group) == list(range(1, sum(g == group for g, _, _ in got) + 1))


def test_ties_get_the_same_numbers_again(spark):
    df = spark.range(0, 500, 1, 3).select((F.col("id") % 5).alias("k"), "id")
    again = df.repartition(7)
    assert rows(record_number(df, ["k"], "n")) == rows(record_number(again, ["k"], "n"))
    assert rows(record_number(df, ["k"], "n")) == rows(gathered(df, ["k"]))


def test_record_number_of_nothing(spark):
    assert record_number(spark.createDataFrame([], "s string"), ["s"], "n").count() == 0
