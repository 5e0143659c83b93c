"""Filters, one row for each key, order, numbering, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from rollwright.operators import dedupe, filters
from rollwright.operators.numbering import record_number
from rollwright.operators.report import union_all


@query(
    "filter_compare",
    """
    SELECT o_orderkey FROM orders
    WHERE nullif(o_orderstatus, 'O') <> 'P' AND o_orderpriority > '2' AND o_orderpriority <> '3-MEDIUM'
    UNION ALL SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'O') = 'P'""",
)
def filter_compare(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("s", F.nullif("o_orderstatus", F.lit("O")))
    high = filters.filter_gt(filters.filter_ne(orders, "s", "P"), "o_orderpriority", "2")
    high = filters.filter_ne(high, "o_orderpriority", "3-MEDIUM")
    return union_all(high.select("o_orderkey"), filters.filter_eq(orders, "s", "P").select("o_orderkey"))


@query(
    "filter_in",
    """
    SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
       AND nullif(c_nationkey, 3) NOT IN (1, 2)""",
)
def filter_in(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("n", F.nullif("c_nationkey", F.lit(3)))
    kept = filters.filter_in(customer, "c_mktsegment", ["BUILDING", "MACHINERY"])
    return filters.filter_not_in(kept, "n", [1, 2]).select("c_custkey")


@query(
    "filter_not_all",
    """
    SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
    WHERE NOT (nullif(l_returnflag, 'N') = 'R' AND l_linestatus = 'O' AND l_quantity > 10)""",
)
def filter_not_all(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    kept = filters.filter_not_all(lines, "nullif(l_returnflag, 'N') = 'R'", "l_linestatus = 'O'", "l_quantity > 10")
    return kept.select("l_orderkey", "l_partkey", "l_linenumber")


@query(
    "filter_not_null",
    """
    SELECT event_id, u, t FROM (SELECT event_id, nullif(user_id, 5) AS u, nullif(event_type, 'view') AS t,
        CASE event_type WHEN 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS score FROM events)
    WHERE u IS NOT NULL AND t IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)""",
)
def filter_not_null(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("user_id", F.lit(5)).alias("u"),
        F.nullif("event_type", F.lit("view")).alias("t"),
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("score"),
    )
    return filters.filter_valid_score(filters.filter_not_null(events, ["u", "t"]), "score").drop("score")


@query(
    "allowed_combinations",
    """
    SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem
    WHERE (l_returnflag IN ('A', 'N') AND l_linestatus IN ('F')) OR (l_returnflag IN ('R') AND l_linenumber IN (1, 2, 3))
    GROUP BY ALL""",
)
def allowed_combinations(spark, sf_dir):
    rules = [
        {"l_returnflag": ["A", "N"], "l_linestatus": ["F"]},
        {"l_returnflag": ["R"], "l_linenumber": [1, 2, 3]},
    ]
    kept = filters.allowed_combinations(table(spark, sf_dir, "lineitem"), rules)
    return kept.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query(
    "partition_split",
    """
    SELECT 'old' AS part, o_orderkey FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'new', o_orderkey FROM orders WHERE o_orderstatus <> 'F'""",
)
def partition_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    parts = filters.partition_split(orders, {"old": "o_orderstatus = 'F'", "new": "o_orderstatus <> 'F'"})
    return union_all(*[df.select(F.lit(name).alias("part"), "o_orderkey") for name, df in parts.items()])


@query(
    "best_row_per_key",
    """
    SELECT o_custkey, p, o_orderkey FROM (
        SELECT o_custkey, o_orderkey, p,
               row_number() OVER (PARTITION BY o_custkey ORDER BY p DESC NULLS FIRST, o_totalprice DESC, o_orderkey) AS r
        FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS p FROM orders)) WHERE r = 1""",
)
def best_row_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("p", F.nullif("o_orderpriority", F.lit("5-LOW")))
    best = dedupe.best_row_per_key(orders, ["o_custkey"], ["p", "o_totalprice"], ["o_orderkey"])
    return best.select("o_custkey", "p", "o_orderkey")


@query(
    "first_row_per_key",
    """
    SELECT l_suppkey, l_shipdate::DATE AS shipped, l_orderkey, l_quantity FROM (
        SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_quantity) AS r FROM lineitem)
    WHERE r = 1""",
)
def first_row_per_key(spark, sf_dir):
    first = dedupe.first_row_per_key(
        table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_quantity"]
    )
    return first.select("l_suppkey", F.col("l_shipdate").cast("date").alias("shipped"), "l_orderkey", "l_quantity")


@query("sort_rows", "SELECT c_custkey, c_mktsegment FROM customer ORDER BY c_mktsegment DESC, c_custkey DESC")
def sort_rows(spark, sf_dir):
    return dedupe.sort_rows(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment", "c_custkey"], reverse=True
    )


@query(
    "record_number",
    """
    SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY s NULLS FIRST, o_orderkey) AS record_number
    FROM (SELECT *, nullif(o_orderstatus, 'O') AS s FROM orders)""",
)
def number_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderstatus", F.lit("O")).alias("s")
    )
    return record_number(orders, ["s", "o_orderkey"]).drop("s")


@query(
    "union_all",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def stack(spark, sf_dir):
    return union_all(
        table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")),
        table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")),
    )
