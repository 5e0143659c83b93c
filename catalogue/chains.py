"""Whole jobs over files and facts: classify to reports, void sets out of files, pages out of files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.jobs import _CLASSIFIED, PAGE_REGIONS, _classify_rules, _facts, _site_tables, page_layout, page_words
from catalogue.registry import query, table
from rollwright.operators.report import LevelFormat, ReportFormat
from rollwright.plans.pages import PageFiles, PageJob, page_job
from rollwright.plans.reports import KindPlan, classify_and_report
from rollwright.plans.roster import FileSource, VoidSource, void_sets_from_files
from rollwright.session import scratch_path
from rollwright.sources.readers import Field

# -- facts to reports -----------------------------------------------------------------------------

_SUBGROUPS = ["support", "priority"]
_SETS = [[], ["support"], ["priority"], ["support", "priority"]]
_LEVELS = {"site": "final_site", "district": "district", "all": None}

# kind: basic columns, view, legal combinations of the zero-filled level.
_KINDS = {
    "C1": (
        ["transformed_grade", "status"],
        "l_linenumber <> 5",
        [
            {"transformed_grade": ["01", "02", "03", "04"], "status": ["REG", "REGSUP", "NONE"]},
            {"transformed_grade": ["10"], "status": ["HIGH", "HIGHSUP", "NONE"]},
        ],
    ),
    "D2": (
        ["transformed_grade", "segment"],
        "NOT (l_linenumber = 5 AND (segment = 'B' OR priority <> '1-URGENT'))",
        [
            {"transformed_grade": ["01", "03", "10"], "segment": ["B"]},
            {"transformed_grade": ["10"], "segment": ["M", "B"], "priority": ["", "1-URGENT", "2-HIGH"]},
        ],
    ),
}


def _columns(basic: list[str]) -> list[str]:
    return [
        "file_record_number", "state_code", "district_identifier", "site_identifier", "table_name", *basic, *_SUBGROUPS,
        "filler", "explanation", "total_indicator", "Counts",
    ]


def _kind(kind: str) -> KindPlan:
    basic, view, allowed = _KINDS[kind]
    form = ReportFormat(
        kind=kind,
        title="LINE COUNTS",
        file_name="XY{short}LINES{kind}.csv",
        identifier="N{kind} {short} {period}",
        period="1998-1999",
        columns=_columns(basic),
        levels={
            "site": LevelFormat("SITE", "SIT", {"district_identifier": F.substring("final_site", 1, 3), "site_identifier": F.col("final_site")}),
            "district": LevelFormat("DISTRICT", "DIS", {"district_identifier": F.col("district"), "site_identifier": ""}),
            "all": LevelFormat("STATE", "STA", {"district_identifier": "", "site_identifier": ""}),
        },
        table_name=F.when(F.col("transformed_grade") == "10", F.lit("UPPER")).otherwise(F.lit("LOWER")),
        fixed={"state_code": "99"},
    )
    return KindPlan(basic, form, view, allowed)


def _held_sql(rules: list[dict[str, list[str]]]) -> str:
    def one(rule):
        return " AND ".join(f"{c} IN ({', '.join(repr(v) for v in values)})" for c, values in rule.items())

    return " OR ".join(f"({one(rule)})" for rule in rules)


def _counts_sql(kind: str, entity: str | None) -> str:
    basic, view, allowed = _KINDS[kind]
    facts = f"(SELECT * REPLACE (CAST(support AS VARCHAR) AS support) FROM c WHERE {view})"
    parts = []
    for used in _SETS:
        shown = ", ".join(c if c in used else f"'' AS {c}" for c in _SUBGROUPS)
        total = "true" if not used else "false"
        keys = [*([entity] if entity else []), *basic, *used]
        held = " AND ".join(f"{c} IS NOT NULL" for c in keys)
        counted = f"SELECT {', '.join(keys)}, count(l_orderkey) AS Counts FROM {facts} WHERE {held} GROUP BY ALL"
        if not entity:
            cells = " CROSS JOIN ".join(f"(SELECT DISTINCT {c} FROM {facts} WHERE {c} IS NOT NULL)" for c in keys)
            using = ", ".join(keys)
            counted = f"SELECT {using}, coalesce(Counts, 0) AS Counts FROM ({cells}) LEFT JOIN ({counted}) USING ({using})"
        front = ", ".join([*([entity] if entity else []), *basic])
        parts.append(f"SELECT {front}, {shown}, Counts, {total} AS is_total FROM ({counted})")
    stacked = " UNION ALL ".join(parts)
    return stacked if entity else f"SELECT * FROM ({stacked}) WHERE {_held_sql(allowed)}"


def _report_sql(kind: str, level: str, title: str, short: str) -> str:
    basic, entity = _KINDS[kind][0], _LEVELS[level]
    counts = _counts_sql(kind, entity)
    order = ", ".join([*([entity] if entity else []), *basic, *_SUBGROUPS])
    district = {"site": "substr(final_site, 1, 3)", "district": "district"}.get(level, "''")
    site = "final_site" if level == "site" else "''"
    body = ["CAST(n AS VARCHAR)", "'99'", district, site, "CASE WHEN transformed_grade = '10' THEN 'UPPER' ELSE 'LOWER' END",
            *basic, *_SUBGROUPS, "''", "''", "CASE WHEN is_total THEN 'Y' ELSE 'N' END", "CAST(Counts AS VARCHAR)"]
    head = [f"'{title} LINE COUNTS'", f"CAST((SELECT count(*) FROM ({counts})) AS VARCHAR)", f"'XY{short}LINES{kind}.csv'",
            f"'N{kind} {short} 1998-1999'", "'1998-1999'", *["''"] * (len(body) - 5)]
    return f"""
    SELECT '{kind}' AS kind, '{level}' AS level, 0::BIGINT AS line_no, concat_ws('|', {', '.join(head)}) AS record
    UNION ALL
    SELECT '{kind}', '{level}', n, concat_ws('|', {', '.join(body)})
    FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS n FROM ({counts}))"""


@query(
    "classify_and_report",
    f"WITH c AS {_CLASSIFIED} " + " UNION ALL ".join(
        _report_sql(kind, level, title, short)
        for kind in _KINDS
        for level, title, short in (("site", "SITE", "SIT"), ("district", "DISTRICT", "DIS"), ("all", "STATE", "STA"))
    ),
)
def facts_to_reports(spark, sf_dir):
    """Six reports of two kinds, each with its own view, basic columns, legal cells and columns; a line a record."""
    reports = classify_and_report(
        _facts(spark, sf_dir), *_site_tables(spark, sf_dir), _classify_rules(), {kind: _kind(kind) for kind in _KINDS}, _SETS, _LEVELS, "l_orderkey"
    )
    lines = [
        df.select(
            F.lit(kind).alias("kind"), F.lit(level).alias("level"), "line_no", F.concat_ws("|", *_columns(_KINDS[kind][0])).alias("record")
        )
        for (kind, level), df in reports.items()
    ]
    return reduce(DataFrame.unionByName, lines)


# -- void sets out of files -----------------------------------------------------------------------


def _text(c, width):
    return F.rpad(F.coalesce(c.cast("string"), F.lit("")), width, " ")


def void_manifest(spark, sf_dir):
    """Three pairs that Spark writes first: fixed width in Latin-1 with CSV, CSV with Parquet, Parquet with fixed width."""
    base = scratch_path(spark, "voids")
    part, lineitem, orders, supplier, customer = (table(spark, sf_dir, t) for t in ("part", "lineitem", "orders", "supplier", "customer"))
    status = F.when(F.col("p_size").isin(3, 4), F.lit("L")).when(F.col("p_size") == 5, F.lit("H")).otherwise(F.lit("ü"))
    line = F.concat(
        F.lpad(F.col("p_partkey").cast("string"), 12, " "), _text(F.lit("né"), 4), _text(F.col("p_partkey") + 7, 12), _text(status, 2)
    )
    # Leading blanks get lost in such files.
    part.select(F.ltrim(line).alias("line")).select(F.encode("line", "ISO-8859-1").cast("string").alias("line")).write.text(f"{base}/first.txt")
    supplier.select((F.col("s_suppkey") * 5).alias("record_id"), (F.col("s_suppkey") + 40).alias("person_id")).write.csv(
        f"{base}/first_ids.csv", header=True
    )
    code = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45), F.lit("X"))
    lineitem.select(
        F.col("l_partkey").cast("string").alias("line"), F.col("l_suppkey").cast("string").alias("own"), code.alias("code")
    ).write.csv(f"{base}/second.csv", header=True)
    supplier.select((F.col("s_suppkey") * 3).alias("record_id"), (F.col("s_suppkey") + 900).alias("person_id")).write.parquet(
        f"{base}/second_ids.parquet"
    )
    orders.select(
        F.col("o_orderkey").cast("string").alias("row_id"), F.col("o_custkey").cast("string").alias("own_id"), F.col("o_orderstatus").alias("status")
    ).write.parquet(f"{base}/third.parquet")
    customer.select(F.concat(F.lpad((F.col("c_custkey") * 7).cast("string"), 12, " "), _text(F.col("c_custkey") + 5, 12)).alias("line")).write.text(
        f"{base}/third_ids.txt"
    )
    fields = [Field(1, 12, "row_id"), Field(13, 4, "note"), Field(17, 12, "own_id"), Field(29, 1, "status")]
    ids = [Field(1, 12, "record_id", "bigint"), Field(13, 12, "person_id", "bigint")]
    return [
        VoidSource(
            "parts", FileSource(f"{base}/first.txt", fields, encoding="ISO-8859-1", width=30),
            FileSource(f"{base}/first_ids.csv", schema="record_id bigint, person_id bigint"), {"L": "late", "H": "handed over"},
        ),
        VoidSource(
            "lines", FileSource(f"{base}/second.csv", schema="line string, own string, code string"), FileSource(f"{base}/second_ids.parquet"),
            {"X": "returned"}, row_id="line", alternative_id="own", status="code",
        ),
        VoidSource("orders", FileSource(f"{base}/third.parquet"), FileSource(f"{base}/third_ids.txt", ids, pad="start", width=24), {"P": "partial"}),
    ]


@query(
    "void_sets_from_files",
    """
    WITH v AS (
        SELECT 1 AS f, coalesce(s_suppkey + 40, p_partkey + 7) AS person_id, CASE WHEN p_size = 5 THEN 'parts: handed over' ELSE 'parts: late' END AS why
        FROM part LEFT JOIN supplier ON p_partkey = s_suppkey * 5 WHERE p_size IN (3, 4, 5)
        UNION ALL
        SELECT 2, coalesce(s.s_suppkey + 900, l_suppkey), 'lines: returned'
        FROM lineitem LEFT JOIN supplier s ON l_partkey = s.s_suppkey * 3 WHERE l_returnflag = 'R' AND l_quantity >= 45
        UNION ALL
        SELECT 3, coalesce(c.c_custkey + 5, o_custkey), 'orders: partial'
        FROM orders LEFT JOIN customer c ON o_orderkey = c.c_custkey * 7 WHERE o_orderstatus = 'P'
    )
    SELECT person_id, max(CASE WHEN f = 1 THEN true END) AS Voided_1, max(CASE WHEN f = 2 THEN true END) AS Voided_2,
           max(CASE WHEN f = 3 THEN true END) AS Voided_3, string_agg(DISTINCT why, '; ' ORDER BY why) AS reasons
    FROM v GROUP BY person_id""",
)
def voided_by_files(spark, sf_dir):
    return void_sets_from_files(spark, void_manifest(spark, sf_dir))


# -- pages out of files ---------------------------------------------------------------------------

_SUBJECT = "English Language Arts"


def page_folder(spark, sf_dir, path: str, subject: str = _SUBJECT) -> None:
    """The customers' pages as files of word boxes, and beside them files that the scan must not open."""
    words = page_words(spark, sf_dir, subject, system_code=True)
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in ("doc", "page", "x0", "y0", "x1", "y1", "word")])
    words.select(line).write.text(path)
    table(spark, sf_dir, "part").select("p_name").write.mode("append").text(path, compression="gzip")


def page_settings(path: str) -> PageJob:
    layout = page_layout()
    names = {c: n for c, n in layout.names.items() if c != layout.score_region}
    codes = {**layout.code_and_name, "School_System": ("School_System_Code", "School_System_Name")}
    layout = type(layout)(**{**layout.__dict__, "names": names, "code_and_name": codes})
    files = PageFiles(path, ".txt", ["part-", "page-"], "c000", ("doc", "page", "x0", "y0", "x1", "y1", "word"))
    return PageJob(files, PAGE_REGIONS, layout, "Report_Subject", {_SUBJECT: "ELA"})


@query(
    "page_job",
    """
    WITH c AS (SELECT *, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code, CAST(c_custkey AS VARCHAR) AS k, split_part(c_name, '#', 2) AS tail, c_mktsegment = 'BUILDING' AS void,
                      lpad(CAST(n_regionkey AS VARCHAR), 3, '0') AS system_code, n_nationkey IN (0, 2, 4, 6, 8, 10) AS even FROM customer JOIN nation ON c_nationkey = n_nationkey),
    records AS (
    SELECT k AS doc, 1 AS page, 'Individual Report' AS Report_Title, 'English Language Arts' AS Report_Subject, 'Spring ' || n_regionkey AS Report_Season_Year,
           '10%' AS Advanced_School_Percentage, '≥' || n_nationkey || '%' AS Advanced_School_System_Percentage, 'NR' AS Advanced_State_Percentage,
           CASE WHEN NOT even THEN '7%' END AS Basic_School_Percentage, CASE WHEN NOT even THEN 'N/A' END AS Basic_School_System_Percentage,
           CASE WHEN NOT even THEN '9%' END AS Basic_State_Percentage, even AS Basic_Mismatch,
           CASE WHEN void THEN '*' ELSE k END AS Scale_Score_ELA, void AS If_Voided,
           CASE WHEN NOT void THEN ' ' || c_mktsegment END AS Reading_Level,
           CASE WHEN NOT void THEN '30%' END AS Reading_Level_State_Percentage_Strong,
           CASE WHEN NOT void AND even THEN '10%' END AS Reading_Level_State_Percentage_Weak,
           CASE WHEN even THEN 'Ann Bea ' || tail ELSE tail END AS Student_Name, '12' AS Summarized_Grade, k AS LASID,
           CASE WHEN even THEN 'Ann' ELSE tail END AS Student_First_Name, tail AS Student_Last_Name, CASE WHEN even THEN 1990 END AS Summarized_DOB_Year,
           code AS School_Code, 'High ' || n_name AS School_Name, system_code AS School_System_Code, c_mktsegment AS School_System_Name
    FROM c)
    SELECT 'parquet' AS form, * FROM records UNION ALL SELECT 'csv', * FROM records""",
)
def pages_from_files(spark, sf_dir):
    """Both published forms, the CSV read back by the Parquet's schema."""
    path = scratch_path(spark, "page-files")
    page_folder(spark, sf_dir, path)
    result = page_job(spark, page_settings(path), scratch_path(spark, "page-records"))
    again = spark.read.csv(result.csv_path, header=True, schema=result.records.schema, escape='"', multiLine=True)
    columns = [
        "doc", "page", "Report_Title", "Report_Subject", "Report_Season_Year", "Advanced_School_Percentage", "Advanced_School_System_Percentage",
        "Advanced_State_Percentage", "Basic_School_Percentage", "Basic_School_System_Percentage", "Basic_State_Percentage", "Basic_Mismatch",
        "Scale_Score_ELA", "If_Voided", "Reading_Level", "Reading_Level_State_Percentage_Strong", "Reading_Level_State_Percentage_Weak",
        "Student_Name", "Summarized_Grade", "LASID", "Student_First_Name", "Student_Last_Name", "Summarized_DOB_Year", "School_Code", "School_Name",
        "School_System_Code", "School_System_Name",
    ]
    return result.records.select(F.lit("parquet").alias("form"), *columns).unionByName(again.select(F.lit("csv").alias("form"), *columns))
