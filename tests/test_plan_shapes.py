"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rollwright.operators import dedupe as D
from rollwright.operators import joins as J
from rollwright.operators import rollup as R
from rollwright.operators.numbering import record_number
from rollwright.operators.regions import region_text
from rollwright.plans.classify import ClassifyRules, roster_classify
from rollwright.plans.pages import PageFiles, read_word_boxes
from rollwright.plans.roster import History, match_split


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df) -> str:
    """The final adaptive plan, after a run."""
    df._jdf.javaToPython().count()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture()
def hot(spark):
    """No broadcast, and thresholds small enough to see skewed partitions being split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def facts(spark, rows=200_000):
    """Every other row has the same key."""
    key = F.when(F.col("id") % 2 == 0, F.lit(1).cast("bigint")).otherwise(F.col("id") % 1000)
    return spark.range(0, rows, 1, 8).select(key.alias("k"), F.xxhash64("id").alias("v"), F.rand(7).alias("w"))


def lookup(spark):
    return spark.range(0, 100_000, 1, 8).select((F.col("id") % 1000).alias("k"), F.col("id").alias("new"))


@pytest.mark.parametrize(
    "build",
    [
        lambda s: J.semi_join(facts(s), lookup(s), "k"),
        lambda s: J.anti_join(facts(s), lookup(s), "k"),
        lambda s: J.membership_flag(facts(s), lookup(s), "k", "known"),
        lambda s: J.replace_by_lookup(facts(s), "k", lookup(s).withColumnRenamed("k", "old"), "old", "new"),
        lambda s: J.left_enrich(facts(s), D.best_row_per_key(lookup(s), ["k"], ["new"]), "k"),
        lambda s: J.left_enrich(facts(s), lookup(s).where("new < 1000"), "k"),
        lambda s: J.left_enrich(facts(s).withColumn("k", F.nullif("k", F.lit(1))), lookup(s).where("new < 1000"), "k"),
    ],
    ids=["semi", "anti", "flag", "replace", "best-row-lookup", "plain-lookup", "null-key"],
)
def test_a_hot_key_is_split(hot, build):
    assert "skew=true" in run_plan(build(hot))


def test_the_roster_join_is_split_at_a_hot_id(hot):
    roster = facts(hot).withColumnRenamed("k", "person_id")
    table = hot.range(0, 50_000, 1, 8).select((F.col("id") % 1000).alias("person_id"), F.rand(3).alias("score"), F.lit("x").alias("source"))
    voids = hot.range(0, 500, 1, 2).select(F.col("id").alias("person_id"))
    out = match_split(roster, History(table, "person_id", "score", "source", ["score"]), voids, ["person_id", "v"])
    assert "skew=true" in run_plan(out.flagged)
    # One join computes the output.
    assert len(re.findall(r"\w+Join", plan(out.flagged).split("== Initial Plan ==")[-1])) == 1


def test_best_row_limits_each_map_task(spark):
    shape = plan(D.best_row_per_key(facts(spark), ["k"], ["v"], ["w"]))
    assert "row_number(), 1, Partial" in shape and "SinglePartition" not in shape


def test_numbering_never_gathers_the_rows(spark):
    shape = plan(record_number(facts(spark, 1000), ["k", "v"]))
    scans = [line for line in shape.split("\n") if "FileScan" in line]
    single = [line for line in shape.split("\n") if "SinglePartition" in line]
    # Only the partition sizes, and of them one row each, meet in one task.
    assert len(scans) == 2 and len(single) == 1 and "ReadSchema: struct<__part:int,__pos:bigint>" in scans[1]


def test_subgroup_sets_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "f")
    facts(spark, 1000).withColumn("s", F.lit("x")).write.parquet(path)
    shape = plan(R.subgroup_rollup(spark.read.parquet(path), ["s"], [[], ["k"], ["v"], ["k", "v"]], "w"))
    assert shape.count("FileScan") == 1 and shape.count("Expand") == 1
    # The facts shrink to their finest grain below the expansion.
    assert shape.index("Expand") < shape.index("partial_count(w")


def test_page_text_is_shuffled_twice(spark):
    words = spark.range(10).selectExpr(
        "id AS doc", "id % 2 AS page", "CAST(id AS DOUBLE) AS x0", "CAST(id AS DOUBLE) AS y0", "CAST(id + 1 AS DOUBLE) AS x1",
        "CAST(id + 1 AS DOUBLE) AS y1", "'w' AS word",
    )
    shape = plan(region_text(words, {"all": (0, 0, 99, 99)}))
    assert len(re.findall(r"Exchange hashpartitioning", shape)) == 2 and "Join" not in shape


def test_page_text_lists_a_line_once_for_all_regions(spark):
    data = [("d", 1, 0.0, 0.0, 1.0, 1.0, "a"), ("d", 1, 1.0, 0.0, 2.0, 1.0, "b"), ("d", 1, 0.0, 1.0, 1.0, 2.0, "c"), ("e", 2, 50.0, 50.0, 51.0, 51.0, "out"), (None, 3, 0.0, 0.0, 1.0, 1.0, None)]
    words = spark.createDataFrame(data, "doc string, page int, x0 double, y0 double, x1 double, y1 double, word string")
    regions = {f"r{i}": (0, 0, 1 + i % 2, 2 - i // 5) for i in range(10)}
    few, many = (plan(region_text(words, r)).count("listagg(") for r in ({"r0": regions["r0"]}, regions))
    assert few == many
    got = {r["doc"]: r for r in region_text(words, regions).collect()}
    assert [got["d"][c] for c in ("r0", "r1", "r5", "r6")] == ["a\nc", "a b\nc", "a b", "a"]
    assert set(got) == {"d", "e", None} and not any(got[d][c] for d in ("e", None) for c in regions)


def test_a_line_of_boxes_is_cut_once(spark, tmp_path):
    (tmp_path / "page.boxes").write_text("1\t0\t0\t1\t1\ta\tb\n1\t0\tx\t1\t1\tw\n1\t0\t0\t1\t1\n")
    boxes = read_word_boxes(spark, PageFiles(str(tmp_path), ".boxes"))
    assert [tuple(r) for r in boxes.collect()] == [("page.boxes", 1, 0.0, 0.0, 1.0, 1.0, "a\tb")]
    assert boxes._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(10).selectExpr("id", "'Y' AS roll", "3 AS kind", "'05' AS grade", "'001001' AS site", "'z' AS unused").write.parquet(path)
    sites = spark.createDataFrame([("001001", "001001")], "site string, site_to string")
    rules = ClassifyRules(
        include="roll = 'Y' OR kind = 5", filters=["kind <> 9"], grade="grade", grade_map={"11": "10"}, site="site",
        conversion=("site", "site_to"), columns=["id", "site_code"],
    )
    shape = plan(roster_classify(spark.read.parquet(path), sites, sites, sites, rules))
    (scan,) = [line for line in shape.split("\n") if "FileScan" in line]
    assert "Or(EqualTo(roll,Y),EqualTo(kind,5))" in scan and "Not(EqualTo(kind,9))" in scan
    assert "unused" not in scan
