"""Counts, subgroup rollups and zero-filled cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from rollwright.functions.columns import zfill
from rollwright.operators import rollup
from rollwright.operators.report import union_all

# Site = nation code, district = its region; some keys and IDs are null.
FACTS = """(
    SELECT CASE WHEN o_totalprice > 20000 THEN o_orderkey END AS id, CASE WHEN c_mktsegment = 'MACHINERY' AND o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS status,
           nullif(c_mktsegment, 'BUILDING') AS segment, nullif(o_orderpriority, '5-LOW') AS priority,
           lpad(CAST(n_regionkey AS VARCHAR), 3, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS site,
           lpad(CAST(n_regionkey AS VARCHAR), 3, '0') AS district
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def order_facts(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    district = zfill("n_regionkey", 3)
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("o_totalprice") > 20000, F.col("o_orderkey")).alias("id"),
            F.expr("CASE WHEN c_mktsegment = 'MACHINERY' AND o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END").alias("status"),
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
            F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
            F.concat(district, zfill("n_nationkey", 3)).alias("site"),
            district.alias("district"),
        )
    )


SETS = [[], ["segment"], ["priority"], ["segment", "priority"]]


def rollup_sql(entity: str | None) -> str:
    """The counts set by set, each over the facts, stacked."""
    keys = f"{entity}, status" if entity else "status"
    parts = []
    for used in SETS:
        shown = ", ".join(c if c in used else f"'' AS {c}" for c in ("segment", "priority"))
        held = " AND ".join(f"{c} IS NOT NULL" for c in ["status", *used])
        total = "true" if not used else "false"
        parts.append(
            f"SELECT {keys}, {shown}, count(id) AS Counts, {total} AS is_total FROM {FACTS} WHERE {held}"
            f" GROUP BY {', '.join([keys, *used])}"
        )
    return " UNION ALL ".join(parts)


ALLOWED = [
    {"status": ["F", "O"], "segment": ["", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD"]},
    {"status": ["P"], "priority": ["", "1-URGENT", "2-HIGH"]},
]


def zero_filled_sql() -> str:
    parts = []
    for used in SETS:
        shown = ", ".join(c if c in used else f"'' AS {c}" for c in ("segment", "priority"))
        domains = " CROSS JOIN ".join(
            f"(SELECT DISTINCT {c} FROM f WHERE {c} IS NOT NULL)" for c in ["status", *used]
        )
        total = "true" if not used else "false"
        using = ", ".join(["status", *used])
        parts.append(
            f"SELECT status, {shown}, coalesce(n, 0) AS Counts, {total} AS is_total FROM ({domains})"
            f" LEFT JOIN (SELECT {using}, count(id) AS n FROM f GROUP BY {using}) USING ({using})"
        )
    return f"""
    WITH f AS {FACTS}, cells AS ({" UNION ALL ".join(parts)})
    SELECT status, segment, priority, Counts, is_total FROM cells
    WHERE (status IN ('F', 'O') AND segment IN ('', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD'))
       OR (status IN ('P') AND priority IN ('', '1-URGENT', '2-HIGH'))"""


@query("group_count", f"SELECT segment, status, count(id) AS Counts FROM {FACTS} GROUP BY segment, status")
def group_count(spark, sf_dir):
    return rollup.group_count(order_facts(spark, sf_dir), ["segment", "status"], "id")


@query("subgroup_rollup", rollup_sql(None))
def subgroup_rollup(spark, sf_dir):
    return rollup.subgroup_rollup(order_facts(spark, sf_dir), ["status"], SETS, "id", total_flag="is_total")


@query(
    "subgroup_rollup_grouping_sets",
    """
    SELECT l_returnflag, CASE WHEN grouping(l_linestatus) = 1 THEN '' ELSE l_linestatus END AS l_linestatus,
           CASE WHEN grouping(l_linenumber) = 1 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
           CASE WHEN grouping(ship_year) = 1 THEN '' ELSE CAST(ship_year AS VARCHAR) END AS ship_year,
           count(l_orderkey) AS Counts
    FROM (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem)
    GROUP BY GROUPING SETS ((l_returnflag), (l_returnflag, l_linestatus), (l_returnflag, l_linenumber),
        (l_returnflag, ship_year), (l_returnflag, ship_year, l_linestatus), (l_returnflag, l_linenumber, l_linestatus))""",
)
def subgroup_rollup_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    sets = [[], ["l_linestatus"], ["l_linenumber"], ["ship_year"], ["ship_year", "l_linestatus"], ["l_linenumber", "l_linestatus"]]
    return rollup.subgroup_rollup(lines, ["l_returnflag"], sets, "l_orderkey")


@query(
    "multi_level_rollup",
    f"""
    SELECT 'site' AS level, site AS entity, status, segment, priority, Counts FROM ({rollup_sql("site")})
    UNION ALL SELECT 'district', district, status, segment, priority, Counts FROM ({rollup_sql("district")})
    UNION ALL SELECT 'all', '', status, segment, priority, Counts FROM ({zero_filled_sql()})""",
)
def multi_level_rollup(spark, sf_dir):
    levels = {"site": "site", "district": "district", "all": None}
    tables = rollup.multi_level_rollup(order_facts(spark, sf_dir), ["status"], SETS, "id", levels, allowed=ALLOWED)
    return union_all(
        *[
            df.select(
                F.lit(level).alias("level"),
                (F.col(levels[level]) if levels[level] else F.lit("")).alias("entity"),
                "status", "segment", "priority", "Counts",
            )
            for level, df in tables.items()
        ]
    )


@query("zero_filled_counts", zero_filled_sql())
def zero_filled_counts(spark, sf_dir):
    return rollup.zero_filled_counts(
        order_facts(spark, sf_dir), ["status"], SETS, "id", allowed=ALLOWED, total_flag="is_total"
    )


@query(
    "cross_scaffold",
    """
    SELECT r AS l_returnflag, s AS l_linestatus, n AS l_linenumber
    FROM (SELECT DISTINCT l_returnflag AS r FROM lineitem), (SELECT DISTINCT l_linestatus AS s FROM lineitem),
         (SELECT DISTINCT l_linenumber AS n FROM lineitem)""",
)
def cross_scaffold(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return rollup.cross_scaffold(lines, ["l_returnflag", "l_linestatus", "l_linenumber"]).drop("__set")


@query("distinct_values", "SELECT DISTINCT l_suppkey FROM lineitem")
def distinct_values(spark, sf_dir):
    return rollup.distinct_values(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query("table_height", "SELECT count(*) AS height FROM lineitem")
def table_height(spark, sf_dir):
    return rollup.table_height(table(spark, sf_dir, "lineitem"))
