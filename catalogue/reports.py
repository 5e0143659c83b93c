"""Numbered reports over subgroup counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.counts import ALLOWED, SETS, order_facts, rollup_sql, zero_filled_sql
from catalogue.registry import query
from rollwright.functions.columns import prefix_of
from rollwright.operators.report import LevelFormat, ReportFormat, build_report
from rollwright.operators.rollup import subgroup_rollup
from rollwright.plans.reports import ReportPlan, publish_reports, subgroup_reports
from rollwright.session import scratch_path
from rollwright.sources.readers import read_delimited

COLUMNS = [
    "file_record_number", "state_code", "district_identifier", "site_identifier", "table_name", "status",
    "segment", "priority", "filler", "explanation", "total_indicator", "Counts",
]

def _format(kind: str) -> ReportFormat:
    """Built at call time: columns need a running session."""
    return ReportFormat(
        kind=kind,
        title="ORDER COUNTS",
        file_name="XY{short}ORDERS{kind}.csv",
        identifier="N{kind} {short} {period}",
        period="1998-1999",
        columns=COLUMNS,
        levels={
            "site": LevelFormat("SITE", "SIT", {"district_identifier": prefix_of("site", 3), "site_identifier": F.col("site")}),
            "district": LevelFormat("DISTRICT", "DIS", {"district_identifier": F.col("district"), "site_identifier": ""}),
            "all": LevelFormat("STATE", "STA", {"district_identifier": "", "site_identifier": ""}),
        },
        table_name=F.when(F.col("status") == "F", F.lit("DONE")).otherwise(F.lit("OPEN")),
        fixed={"state_code": "99"},
    )


def _report_sql(kind: str, level: str, title: str, short: str, counts: str, entity: str | None) -> str:
    order = ", ".join([*([entity] if entity else []), "status", "segment", "priority"])
    district = {"site": "substr(site, 1, 3)", "district": "district"}.get(level, "''")
    site = "site" if level == "site" else "''"
    return f"""
    SELECT 0::BIGINT AS line_no, '{title} ORDER COUNTS' AS file_record_number, CAST((SELECT count(*) FROM ({counts})) AS VARCHAR) AS state_code,
           'XY{short}ORDERS{kind}.csv' AS district_identifier, 'N{kind} {short} 1998-1999' AS site_identifier,
           '1998-1999' AS table_name, '' AS status, '' AS segment, '' AS priority, '' AS filler, '' AS explanation,
           '' AS total_indicator, '' AS Counts
    UNION ALL
    SELECT n, CAST(n AS VARCHAR), '99', {district}, {site}, CASE WHEN status = 'F' THEN 'DONE' ELSE 'OPEN' END, status,
           segment, priority, '', '', CASE WHEN is_total THEN 'Y' ELSE 'N' END, CAST(Counts AS VARCHAR)
    FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS n FROM ({counts}))"""


@query("report_site", _report_sql("S1", "site", "SITE", "SIT", rollup_sql("site"), "site"))
def report_site(spark, sf_dir):
    counts = subgroup_rollup(order_facts(spark, sf_dir), ["site", "status"], SETS, "id", total_flag="is_total")
    return build_report(counts, _format("S1"), "site", ["site", "status", "segment", "priority"], total="is_total")


_BUNDLE = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, '{level}' AS level, * FROM ({_report_sql(kind, level, title, short, counts, entity)})"
    for kind in ("A1", "B2")
    for level, title, short, counts, entity in (
        ("site", "SITE", "SIT", rollup_sql("site"), "site"),
        ("district", "DISTRICT", "DIS", rollup_sql("district"), "district"),
        ("all", "STATE", "STA", zero_filled_sql(), None),
    )
)


def _reports(spark, sf_dir):
    facts = order_facts(spark, sf_dir)
    plans = {kind: ReportPlan(facts, ["status"], _format(kind), allowed=ALLOWED) for kind in ("A1", "B2")}
    return subgroup_reports(plans, SETS, {"site": "site", "district": "district", "all": None}, "id")


@query("subgroup_reports", _BUNDLE)
def report_bundle(spark, sf_dir):
    tagged = [
        df.select(F.lit(kind).alias("kind"), F.lit(level).alias("level"), "*")
        for (kind, level), df in _reports(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, tagged)


@query("publish_reports", f"SELECT * EXCLUDE (line_no) FROM ({_BUNDLE})")
def published(spark, sf_dir):
    reports = _reports(spark, sf_dir)
    names = {(kind, level): f"{kind}_{level}" for kind, level in reports}
    paths = publish_reports(reports, scratch_path(spark, "reports"), names)
    read = [
        read_delimited(spark, path, COLUMNS, sep=",", encoding="UTF-8").na.fill("").select(F.lit(kind).alias("kind"), F.lit(level).alias("level"), "*")
        for (kind, level), path in paths.items()
    ]
    return reduce(DataFrame.unionByName, read)
