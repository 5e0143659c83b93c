"""The chained jobs on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from rollwright.functions.columns import compose_key, zfill
from rollwright.operators.regions import region_text
from rollwright.operators.report import union_all
from rollwright.plans.classify import ClassifyRules, MarkGroup, roster_classify, roster_views
from rollwright.plans.pages import PageLayout, extract_pages, page_mismatches, page_records
from rollwright.plans.roster import (
    EnrichRules,
    History,
    RosterRules,
    VoidFile,
    clean_crosswalk,
    history_prepare,
    match_split,
    publish_match,
    roster_prepare,
    unmatched_enrich,
    void_sets,
)
from rollwright.session import materialise, scratch_path
from rollwright.sources.sinks import write_named_outputs

# -- inputs shaped like a roster ----------------------------------------------------------------

_ROSTER = """(
    SELECT c_custkey AS id, c_name AS last_name, n_regionkey AS r, n_nationkey AS n,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '11' ELSE '12' END AS grade,
           CASE WHEN c_acctbal < 0 THEN '5' ELSE '1' END AS kind,
           CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 28 + 1 AS VARCHAR) AS day,
           CASE WHEN n_nationkey = 4 THEN '1900' ELSE '2006' END AS year
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def roster_lines(spark, sf_dir):
    """All-text roster with blanks around its codes."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(".0")).alias("person_id"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" 11")).otherwise(F.lit("12 ")).alias("grade"),
        F.when(F.col("c_acctbal") < 0, F.lit("5 ")).otherwise(F.lit("1")).alias("record_kind"),
        zfill("n_regionkey", 3).alias("district_code"),
        F.concat(F.col("n_nationkey").cast("string"), F.lit(" ")).alias("site_part"),
        (F.floor(F.abs("c_acctbal")).cast("bigint") % 28 + 1).cast("string").alias("birth_day"),
        F.lit("7").alias("birth_month"),
        F.when(F.col("n_nationkey") == 4, F.lit("1900")).otherwise(F.lit("2006")).alias("birth_year"),
    )


def site_list(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    code = compose_key(zfill("n_regionkey", 3), zfill("n_nationkey", 3))
    return joined.select(
        F.when(F.col("n_nationkey") == 9, F.lit("")).otherwise(code).alias("site_code"),
        F.col("r_name").alias("district_name"),
        F.col("n_name").alias("site_name"),
        F.when(F.col("n_nationkey") == 7, F.lit("S99")).otherwise(F.lit("")).alias("report_code"),
    )


def retired_ids(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 3).alias("retired_id"), (F.col("s_suppkey") * 3 + 1).alias("active_id")
    )


_RULES = RosterRules(
    grade="12",
    other_grade="11",
    drop_kind="5",
    drop_site_part="13",
    excluded_sites=["001001"],
    special_report_code="S99",
    special_district_name="Special",
    site_shown_above="003",
    site_shown_except=["S99"],
)

_PREPARED = f"""(
    SELECT coalesce(active_id, id) AS person_id, last_name, grade, kind AS record_kind,
           CASE WHEN dc > '003' AND dc <> 'S99' THEN site_code ELSE dc END AS district_code,
           CASE WHEN dc > '003' AND dc <> 'S99' THEN site_name ELSE dn END AS district_name,
           site_code, site_name, CAST(n AS VARCHAR) AS site_part, CASE WHEN length(day) < 2 THEN '0' || day ELSE day END AS birth_day,
           '7' AS birth_month, year AS birth_year
    FROM (SELECT p.*, active_id, site_name, CASE WHEN report_code = 'S99' THEN 'S99' ELSE lpad(CAST(r AS VARCHAR), 3, '0') END AS dc,
                 CASE WHEN report_code = 'S99' THEN 'Special' ELSE district_name END AS dn
          FROM (SELECT *, lpad(CAST(r AS VARCHAR), 3, '0') || lpad(CAST(n AS VARCHAR), 3, '0') AS site_code FROM {_ROSTER}) p
          LEFT JOIN (SELECT s_suppkey * 3 AS retired_id, s_suppkey * 3 + 1 AS active_id FROM supplier) ON id = retired_id
          LEFT JOIN (SELECT CASE WHEN n_nationkey = 9 THEN '' ELSE lpad(CAST(n_regionkey AS VARCHAR), 3, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') END AS sc,
                            r_name AS district_name, n_name AS site_name, CASE WHEN n_nationkey = 7 THEN 'S99' ELSE '' END AS report_code
                     FROM nation JOIN region ON n_regionkey = r_regionkey) ON site_code = sc
          WHERE kind <> '5' AND n <> 13 AND grade = '12' AND site_code <> '001001'))"""


def _prepared(spark, sf_dir):
    return roster_prepare(
        roster_lines(spark, sf_dir), site_list(spark, sf_dir), retired_ids(spark, sf_dir), _RULES
    )


@query(
    "roster_prepare",
    f"""
    SELECT person_id, last_name, district_code, district_name, site_code, birth_day,
           district_code || '_' || district_name AS district_code_name FROM {_PREPARED}""",
)
def prepared_roster(spark, sf_dir):
    return _prepared(spark, sf_dir).roster.select(
        "person_id", "last_name", "district_code", "district_name", "site_code", "birth_day", "district_code_name"
    )


@query(
    "roster_other_grade",
    f"""
    SELECT id AS person_number, grade, lpad(CAST(r AS VARCHAR), 3, '0') || lpad(CAST(n AS VARCHAR), 3, '0') AS site_code, day AS birth_day
    FROM {_ROSTER} WHERE kind <> '5' AND n <> 13 AND grade = '11'""",
)
def other_grade(spark, sf_dir):
    other = _prepared(spark, sf_dir).other_grade
    number = F.trim("person_id").cast("double").cast("bigint").alias("person_number")
    return other.select(number, "grade", "site_code", "birth_day")


# -- void sets ----------------------------------------------------------------------------------

_VOIDS = """(
    WITH m1 AS (SELECT p_partkey AS row_id, p_size, p_partkey + 7 AS own FROM part),
         v1 AS (SELECT DISTINCT coalesce(s_suppkey + 40, own) AS person_id FROM m1 LEFT JOIN supplier ON row_id = s_suppkey * 5
                WHERE p_size IN (3, 4, 5)),
         v2 AS (SELECT DISTINCT coalesce(s_suppkey + 40, l_partkey) AS person_id FROM lineitem LEFT JOIN supplier ON l_partkey = s_suppkey * 5
                WHERE l_returnflag = 'R' AND l_quantity >= 45)
    SELECT coalesce(v1.person_id, v2.person_id) AS person_id, CASE WHEN v1.person_id IS NOT NULL THEN true END AS Voided_1,
           CASE WHEN v2.person_id IS NOT NULL THEN true END AS Voided_2
    FROM v1 FULL OUTER JOIN v2 ON v1.person_id = v2.person_id)"""


def _voids(spark, sf_dir):
    id_map = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 5).alias("record_id"), (F.col("s_suppkey") + 40).alias("person_id")
    )
    first = table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(".0 ")).alias("row_id"),
        (F.col("p_partkey") + 7).cast("string").alias("own_id"),
        F.when(F.col("p_size").isin(3, 4), F.lit("L")).when(F.col("p_size") == 5, F.lit("H")).otherwise(F.lit("")).alias("status"),
    )
    second = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("line"),
        F.col("l_partkey").cast("string").alias("own_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45), F.lit("H")).alias("status"),
    )
    return void_sets([VoidFile(first, id_map), VoidFile(second, id_map, row_id="line")], ["L", "H"])


@query("void_sets", f"SELECT * FROM {_VOIDS}")
def voided(spark, sf_dir):
    return _voids(spark, sf_dir)


# -- match and enrich ---------------------------------------------------------------------------


def _history(spark, sf_dir):
    """Every order; those of each fifth customer under an ID that no roster has."""
    person = F.when(F.col("o_custkey") % 5 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select(
        person.cast("string").alias("person_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("score"),
        F.col("o_orderpriority").alias("source"),
        "o_orderkey",
    )
    current = history_prepare(orders, "person_id", retired_ids(spark, sf_dir))
    return History(
        current, "person_id", "score", "source", rank_by=["priority", "score"], tiebreak=["o_orderkey"],
        priorities=[("HIGH", 1), ("LOW", 0)],
    )


def _match(spark, sf_dir, write_once=False):
    prepared = _prepared(spark, sf_dir)
    # A made null ID: neither matched nor unmatched, flagged N.
    roster = prepared.roster.withColumn("person_id", F.when(F.col("site_part") != "6", F.col("person_id")))
    keep = ["district_code_name", "site_name", "site_code", "last_name", "person_id", "birth_day"]
    names = {"district_code_name": "split", "site_name": "School_Name", "birth_day": "Birth_Date"}
    return prepared, match_split(roster, _history(spark, sf_dir), _voids(spark, sf_dir), keep, names=names, write_once=write_once)


_MATCH = f"""
    WITH retired AS (SELECT s_suppkey * 3 AS retired_id, s_suppkey * 3 + 1 AS active_id FROM supplier),
    roster AS (SELECT CASE WHEN site_part <> '6' THEN person_id END AS person_id, district_code || '_' || district_name AS split,
                      site_name AS School_Name, site_code, last_name, birth_day, birth_month, birth_year FROM {_PREPARED}),
    history AS (SELECT coalesce(active_id, person) AS id, CASE o_orderstatus WHEN 'P' THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END AS s,
                       CASE WHEN contains(lower(o_orderpriority), 'high') THEN 1 WHEN contains(lower(o_orderpriority), 'low') THEN 0 END AS pr, o_orderkey
                FROM (SELECT *, CASE WHEN o_custkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS person FROM orders) LEFT JOIN retired ON person = retired_id),
    best AS (SELECT id, s0 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pr DESC NULLS FIRST, s0 DESC NULLS FIRST, o_orderkey) AS r
                                 FROM (SELECT *, CASE WHEN isnan(s) THEN 0 ELSE s END AS s0 FROM history)) WHERE r = 1),
    h AS (SELECT DISTINCT id FROM history WHERE s IS NOT NULL AND NOT isnan(s)),
    v AS (SELECT person_id AS id FROM {_VOIDS}),
    flagged AS (SELECT *, coalesce(person_id IN (SELECT id FROM h), false) AS in_h, coalesce(person_id IN (SELECT id FROM v), false) AS in_v FROM roster)"""


@query(
    "match_split_matched",
    _MATCH
    + """
    SELECT split, School_Name, site_code, last_name, CAST(person_id AS VARCHAR) AS person_id, birth_day AS Birth_Date,
           CAST(CAST(trunc(coalesce(s0, 0)) AS BIGINT) AS VARCHAR) AS score_composite,
           CASE WHEN in_v AND NOT in_h THEN 'Y' END AS district_pay
    FROM flagged LEFT JOIN best ON person_id = best.id WHERE in_h OR in_v""",
)
def matched(spark, sf_dir):
    return _match(spark, sf_dir)[1].matched


@query(
    "match_split_unmatched",
    _MATCH
    + """
    SELECT split, School_Name, site_code, last_name, CAST(person_id AS VARCHAR) AS person_id, birth_day AS Birth_Date
    FROM flagged WHERE person_id IS NOT NULL AND NOT in_h AND NOT in_v""",
)
def unmatched(spark, sf_dir):
    return _match(spark, sf_dir)[1].unmatched


@query(
    "match_split_flagged",
    _MATCH + " SELECT person_id, last_name, CASE WHEN in_h OR in_v THEN 'Y' ELSE 'N' END AS if_matched FROM flagged",
)
def flagged(spark, sf_dir):
    return _match(spark, sf_dir)[1].flagged.select("person_id", "last_name", "if_matched")


@query(
    "publish_match",
    _MATCH
    + """
    SELECT CASE WHEN in_h OR in_v THEN 'MATCH' ELSE 'NO_MATCH' END AS output, last_name, CAST(person_id AS VARCHAR) AS person_id
    FROM flagged WHERE person_id IS NOT NULL""",
)
def published_match(spark, sf_dir):
    paths = publish_match(_match(spark, sf_dir, write_once=True)[1], scratch_path(spark, "match"), "parquet")
    read = [spark.read.parquet(p).select(F.lit(n).alias("output"), "last_name", "person_id") for n, p in paths.items()]
    return union_all(*read)


def _crosswalk(spark, sf_dir):
    """One row for each customer of a site, the old codes of some, no organization for one."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    code = compose_key(zfill("n_regionkey", 3), zfill("n_nationkey", 3))
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("n_nationkey") < 5, F.concat(F.lit("OLD"), code)).otherwise(code).alias("site_code"),
        F.when(F.col("n_nationkey") != 8, F.concat("c_mktsegment", "c_name")).alias("organization"),
        F.col("n_regionkey").cast("string").alias("parent"),
    )
    site_map = nation.where("n_nationkey < 5").select(F.concat(F.lit("OLD"), code).alias("old_site"), code.alias("new_site"))
    return clean_crosswalk(rows, site_map, ["002011"], "site_code", "organization", "parent")


_CROSSWALK = """(
    SELECT lpad(CAST(n_regionkey AS VARCHAR), 3, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS site_code,
           min(CASE WHEN n_nationkey <> 8 THEN c_mktsegment || c_name END) AS organization, CAST(n_regionkey AS VARCHAR) AS parent
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey, n_nationkey)"""


@query("clean_crosswalk", f"SELECT * FROM {_CROSSWALK} WHERE site_code <> '002011'")
def crosswalk(spark, sf_dir):
    return _crosswalk(spark, sf_dir)


_ENRICHED = (
    _MATCH
    + f""",
    people AS (SELECT person_id, last_name, site_code, birth_day, birth_month, birth_year FROM flagged WHERE NOT (in_h OR in_v)
               UNION ALL
               SELECT id, last_name, lpad(CAST(r AS VARCHAR), 3, '0') || lpad(CAST(n AS VARCHAR), 3, '0'), day, '7', year
               FROM {_ROSTER} WHERE kind <> '5' AND n <> 13 AND grade = '11'),
    cw AS (SELECT site_code AS site, organization FROM {_CROSSWALK} WHERE organization IS NOT NULL)
    SELECT CAST(person_id AS VARCHAR) AS "State ID", last_name, organization,
           CASE WHEN substr(site_code, 1, 1) IN ('5', '6') THEN 'X' ELSE 'Y' END AS opt_in,
           CASE WHEN birth_year = '1900' THEN birth_day ELSE birth_month || '/' || birth_day || '/' || birth_year END AS birth_date,
           CAST(NULL AS VARCHAR) AS Extra_1, 'ACTIVE' AS state
    FROM people JOIN cw ON site_code = site WHERE site <> '002011'"""
)


def _enriched(spark, sf_dir):
    prepared, match = _match(spark, sf_dir)
    rules = EnrichRules(
        keep=["person_id", "last_name", "site_code", "birth_day", "birth_month", "birth_year"],
        final=["State ID", "last_name", "organization", "opt_in", "birth_date", "Extra_1", "state"],
        no_opt_in_firsts=["5", "6"],
        null_columns=["Extra_1"],
        fixed_columns={"state": "ACTIVE"},
        names={"person_id": "State ID"},
        text_columns=["State ID"],
    )
    return unmatched_enrich(match.flagged, prepared.other_grade, _crosswalk(spark, sf_dir), rules)


@query("unmatched_enrich", _ENRICHED)
def enriched(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query("publish_unmatched", _ENRICHED)
def published_unmatched(spark, sf_dir):
    paths = write_named_outputs({"UNMATCHED": _enriched(spark, sf_dir)}, scratch_path(spark, "unmatched"))
    return spark.read.parquet(paths["UNMATCHED"])


# -- classification -----------------------------------------------------------------------------

_FACTS = """(
    SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, o_orderstatus,
           nullif(o_orderpriority, '5-LOW') AS priority, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS grade,
           lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || substr(c_mktsegment, 1, 1) AS site, c_mktsegment
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def _facts(spark, sf_dir):
    lineitem, orders, customer = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customer, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.withColumns(
        {
            "priority": F.nullif("o_orderpriority", F.lit("5-LOW")),
            "grade": zfill("l_linenumber", 2),
            "site": F.concat(zfill("c_nationkey", 3), F.substring("c_mktsegment", 1, 1)),
        }
    )


def _site_tables(spark, sf_dir):
    """Conversion, open sites and listed sites, out of the customers' own sites."""
    customer = table(spark, sf_dir, "customer")
    code = F.concat(zfill("c_nationkey", 3), F.substring("c_mktsegment", 1, 1))
    sites = customer.select(code.alias("site"), "c_nationkey", "c_mktsegment").distinct()
    conversion = sites.where("c_mktsegment = 'AUTOMOBILE'").select(
        F.col("site").alias("site_from"), F.concat(F.substring("site", 1, 3), F.lit("B")).alias("site_to")
    )
    closed = F.col("c_nationkey").isin(2, 6, 7, 10, 14, 15, 18, 22, 23)
    opened = sites.select("site", F.when(closed, F.lit(6)).otherwise(F.lit(1)).alias("status"))
    listed = sites.where("c_nationkey <> 12").select("site")
    return conversion, opened, listed


def _classify_rules(apply_override: bool = False) -> ClassifyRules:
    low, high = "grade_group = 1", "grade_group = 2"
    return ClassifyRules(
        include="(l_returnflag = 'R' AND (l_linestatus = 'O' OR l_discount > 0.05)) OR l_linenumber = 5",
        filters=[
            "o_orderstatus IN ('F', 'O')",
            "substring(site, 1, 3) NOT IN ('000', '020')",
            "NOT (l_linenumber = 7 AND l_quantity > 45 AND priority = '1-URGENT')",
        ],
        grade="grade",
        grade_map={"05": "10", "06": "10", "07": "10"},
        site="site",
        site_out="final_site",
        district_out="district",
        open_when="status NOT IN (2, 6, 7)",
        flags={
            "support": [
                MarkGroup("l_linenumber = 1"),
                MarkGroup("l_linenumber = 3 AND priority = '2-HIGH'", ["l_returnflag", "l_linestatus"], "R"),
                MarkGroup("l_linenumber IN (4, 5)", ["l_returnflag", "l_linestatus"], "O", as_text=True),
            ],
            "taken": [MarkGroup("l_quantity > 20 AND priority IS NOT NULL")],
        },
        derived=[
            ("grade_group", [("transformed_grade IN ('01', '02', '03', '04')", 1), ("transformed_grade NOT IN ('01', '02', '03', '04')", 2)], None),
            (
                "status",
                [
                    (f"{low} AND taken AND l_linenumber IN (1, 3) AND NOT support", "REG"),
                    (f"{low} AND taken AND l_linenumber IN (1, 3) AND support", "REGSUP"),
                    (f"{low} AND NOT taken", "NONE"),
                    (f"{high} AND taken AND NOT support", "HIGH"),
                    (f"{high} AND taken AND support", "HIGHSUP"),
                    (f"{high} AND NOT taken", "NONE"),
                    ("l_linenumber = 5", "OTHER"),
                ],
                None,
            ),
            ("segment", [("c_mktsegment = 'BUILDING'", "B"), ("c_mktsegment = 'MACHINERY'", "M")], None),
        ],
        overrides={"status": ([("l_tax = 0", "EXEMPT")], apply_override)},
        columns=[
            "l_orderkey", "l_partkey", "l_linenumber", "transformed_grade", "final_site", "district", "support", "status", "segment", "priority",
        ],
    )


_CLASSIFIED = f"""(
    WITH sites AS (SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || substr(c_mktsegment, 1, 1) AS site, c_nationkey, c_mktsegment FROM customer),
    kept AS (SELECT *, CASE grade WHEN '05' THEN '10' WHEN '06' THEN '10' WHEN '07' THEN '10' ELSE grade END AS transformed_grade FROM {_FACTS}
             WHERE ((l_returnflag = 'R' AND (l_linestatus = 'O' OR l_discount > 0.05)) OR l_linenumber = 5)
               AND o_orderstatus IN ('F', 'O') AND substr(site, 1, 3) NOT IN ('000', '020')
               AND NOT (l_linenumber = 7 AND l_quantity > 45 AND priority = '1-URGENT')),
    placed AS (SELECT k.*, coalesce(substr(s.site, 1, 3) || 'B', k.site) AS final_site FROM kept k
               LEFT JOIN (SELECT site FROM sites WHERE c_mktsegment = 'AUTOMOBILE') s ON k.site = s.site),
    checked AS (SELECT *, substr(final_site, 1, 3) AS district FROM placed
                WHERE final_site IN (SELECT site FROM sites WHERE c_nationkey NOT IN (2, 6, 7, 10, 14, 15, 18, 22, 23))
                  AND final_site IN (SELECT site FROM sites WHERE c_nationkey <> 12)),
    flags AS (SELECT *, CASE WHEN l_linenumber = 1 THEN true
                             WHEN l_linenumber = 3 AND priority = '2-HIGH' AND (l_returnflag = 'R' OR l_linestatus = 'R') THEN true
                             WHEN l_linenumber IN (4, 5) AND (l_returnflag = 'O' OR l_linestatus = 'O') THEN true ELSE false END AS support,
                     l_quantity > 20 AND priority IS NOT NULL AS taken,
                     CASE WHEN transformed_grade IN ('01', '02', '03', '04') THEN 1 ELSE 2 END AS g FROM checked)
    SELECT l_orderkey, l_partkey, l_linenumber, transformed_grade, final_site, district, support, priority, l_tax,
           CASE WHEN g = 1 AND taken AND l_linenumber IN (1, 3) AND NOT support THEN 'REG'
                WHEN g = 1 AND taken AND l_linenumber IN (1, 3) AND support THEN 'REGSUP'
                WHEN g = 1 AND NOT taken THEN 'NONE' WHEN g = 2 AND taken AND NOT support THEN 'HIGH'
                WHEN g = 2 AND taken AND support THEN 'HIGHSUP' WHEN g = 2 AND NOT taken THEN 'NONE'
                WHEN l_linenumber = 5 THEN 'OTHER' END AS status,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' END AS segment
    FROM flags)"""


@query("roster_classify", f"SELECT * EXCLUDE (l_tax) FROM {_CLASSIFIED}")
def classified(spark, sf_dir):
    return roster_classify(_facts(spark, sf_dir), *_site_tables(spark, sf_dir), _classify_rules())


@query(
    "roster_classify_override",
    f"SELECT * EXCLUDE (l_tax) REPLACE (CASE WHEN l_tax = 0 THEN 'EXEMPT' ELSE status END AS status) FROM {_CLASSIFIED}",
)
def classified_override(spark, sf_dir):
    return roster_classify(_facts(spark, sf_dir), *_site_tables(spark, sf_dir), _classify_rules(True))


@query(
    "roster_views",
    f"""
    SELECT 'part' AS view, l_orderkey, l_partkey, l_linenumber FROM {_CLASSIFIED}
    WHERE NOT (l_linenumber = 5 AND (segment = 'B' OR priority <> '1-URGENT'))
    UNION ALL SELECT 'perf', l_orderkey, l_partkey, l_linenumber FROM {_CLASSIFIED} WHERE l_linenumber <> 5""",
)
def views(spark, sf_dir):
    roster = roster_classify(_facts(spark, sf_dir), *_site_tables(spark, sf_dir), _classify_rules())
    roster = materialise(roster, "roster")  # both views read it
    split = roster_views(
        roster,
        {"part": "NOT (l_linenumber = 5 AND (segment = 'B' OR priority <> '1-URGENT'))", "perf": "l_linenumber <> 5"},
    )
    return union_all(*[df.select(F.lit(n).alias("view"), "l_orderkey", "l_partkey", "l_linenumber") for n, df in split.items()])


# -- page records -------------------------------------------------------------------------------

PAGE_REGIONS = {
    "Title": (0.0, 0.0, 100.0, 3.0),
    "Info": (0.0, 10.0, 100.0, 17.0),
    "Percent_Achievement_Level_Advanced": (0.0, 20.0, 100.0, 21.0),
    "Percent_Achievement_Level_Basic": (0.0, 21.0, 100.0, 22.0),
    "Student_Performance_Score": (0.0, 30.0, 100.0, 32.0),
    "Reading_Level": (0.0, 40.0, 100.0, 42.0),
    "Reading_Level_Shares": (0.0, 50.0, 100.0, 53.0),
}


def page_layout() -> PageLayout:
    return PageLayout(
        title_region="Title",
        title_columns=["Report_Title", "Report_Subject", "Report_Season_Year"],
        info_region="Info",
        score_region="Student_Performance_Score",
        levels=["Advanced", "Basic"],
        trimmed={"Student_Performance_Score": [("\n", " "), ("SCORE", "")]},
        details=["Reading_Level", "Reading_Level_Shares"],
        cleaned=["Reading_Level"],
        shares={"Reading_Level": "Reading_Level_Shares"},
        code_and_name={"School": ("School_Code", "School_Name")},
        names={"Grade": "Summarized_Grade", "Student_Performance_Score": "Scale_Score_ELA"},
    )


def page_words(spark, sf_dir, subject: str = "Language", system_code: bool = False):
    """One page for each customer: its printed lines, cut into word boxes."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey").cast("string")
    tail = F.substring_index("c_name", "#", -1)
    even = F.col("n_nationkey").isin(0, 2, 4, 6, 8, 10)
    name = F.when(even, F.concat(F.lit("Ann Bea "), tail)).otherwise(tail)
    lines = [
        (0, F.lit("Individual Report")),
        (1, F.lit(subject)),
        (2, F.concat(F.lit("Spring "), F.col("n_regionkey").cast("string"))),
        (10, F.concat(F.lit("Student: "), name, F.lit(" Grade: 12"))),
        (11, F.lit("Report Date: 01/02/1998")),
        (12, F.concat(F.lit("LASID: "), key)),
        (13, F.concat(F.lit("School: "), zfill("n_nationkey", 3), F.lit(" High "), F.col("n_name"))),
        (14, F.when(even, F.lit("Date of Birth: 03/04/1990")).otherwise(F.lit("Date of Birth: --/--/----"))),
        (15, F.concat(F.lit("School System: "), *([zfill("n_regionkey", 3), F.lit(" ")] if system_code else []), F.col("c_mktsegment"))),
        (20, F.concat(F.lit("10% ≥"), F.col("n_nationkey").cast("string"), F.lit("% NR"))),
        (21, F.when(even, F.lit("7% 8%")).otherwise(F.lit("7% N/A 9%"))),
        (30, F.lit("SCORE")),
        (31, F.when(F.col("c_mktsegment") == "BUILDING", F.lit("*")).otherwise(key)),
        (40, F.lit("«««")),
        (41, F.col("c_mktsegment")),
        (50, F.lit("30%")),
        (51, F.lit("≥60%")),
        (52, F.when(even, F.lit("10%")).otherwise(F.lit(""))),
    ]
    printed = joined.select(
        key.alias("doc"),
        F.explode(F.array(*[F.struct(F.lit(y).alias("y"), t.alias("line")) for y, t in lines])).alias("at"),
    )
    words = printed.select("doc", "at.y", F.posexplode(F.split("at.line", " ")).alias("x", "word")).where("word <> ''")
    return words.select(
        "doc",
        F.lit(1).alias("page"),
        F.col("x").cast("double").alias("x0"),
        F.col("y").cast("double").alias("y0"),
        (F.col("x") + 1).cast("double").alias("x1"),
        (F.col("y") + 1).cast("double").alias("y1"),
        "word",
    )


def _page_texts(spark, sf_dir):
    return extract_pages(region_text(page_words(spark, sf_dir), PAGE_REGIONS), page_layout())


@query(
    "page_records",
    """
    WITH c AS (SELECT *, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code, CAST(c_custkey AS VARCHAR) AS k, split_part(c_name, '#', 2) AS tail, c_mktsegment = 'BUILDING' AS void,
                      n_nationkey IN (0, 2, 4, 6, 8, 10) AS even FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT k AS doc, 1 AS page, 'Individual Report' AS Report_Title, 'Language' AS Report_Subject, 'Spring ' || n_regionkey AS Report_Season_Year,
           '10%' AS Advanced_School_Percentage, '≥' || n_nationkey || '%' AS Advanced_School_System_Percentage, 'NR' AS Advanced_State_Percentage,
           CASE WHEN NOT even THEN '7%' END AS Basic_School_Percentage, CASE WHEN NOT even THEN 'N/A' END AS Basic_School_System_Percentage,
           CASE WHEN NOT even THEN '9%' END AS Basic_State_Percentage, false AS Advanced_Mismatch, even AS Basic_Mismatch,
           concat_ws(chr(10), 'Student: ' || CASE WHEN even THEN 'Ann Bea ' ELSE '' END || tail || ' Grade: 12', 'Report Date: 01/02/1998', 'LASID: ' || k,
                     'School: ' || code || ' High ' || n_name, 'Date of Birth: ' || CASE WHEN even THEN '03/04/1990' ELSE '--/--/----' END,
                     'School System: ' || c_mktsegment) AS Info,
           CASE WHEN void THEN '*' ELSE k END AS Scale_Score_ELA, void AS If_Voided,
           CASE WHEN NOT void THEN ' ' || c_mktsegment END AS Reading_Level,
           CASE WHEN NOT void THEN '30%' END AS Reading_Level_State_Percentage_Strong,
           CASE WHEN NOT void THEN '≥60%' END AS Reading_Level_State_Percentage_Moderate,
           CASE WHEN NOT void AND even THEN '10%' END AS Reading_Level_State_Percentage_Weak,
           CASE WHEN even THEN 'Ann Bea ' || tail ELSE tail END AS Student_Name,
           '12' AS Summarized_Grade, '01/02/1998' AS Report_Date, k AS LASID, c_mktsegment AS School_System,
           CASE WHEN even THEN 'Ann' ELSE tail END AS Student_First_Name, CASE WHEN even THEN 'Bea' END AS Student_Middle_Initial,
           tail AS Student_Last_Name, CASE WHEN even THEN 4 END AS Summarized_DOB_Day, CASE WHEN even THEN 3 END AS Summarized_DOB_Month,
           CASE WHEN even THEN 1990 END AS Summarized_DOB_Year,
           code AS School_Code, 'High ' || n_name AS School_Name
    FROM c""",
)
def page_rows(spark, sf_dir):
    return page_records(page_words(spark, sf_dir), PAGE_REGIONS, page_layout())


@query(
    "page_mismatches",
    "SELECT CAST(c_custkey AS VARCHAR) AS doc, 'Basic' AS level FROM customer WHERE c_nationkey IN (0, 2, 4, 6, 8, 10)",
)
def mismatches(spark, sf_dir):
    return page_mismatches(_page_texts(spark, sf_dir), page_layout()).drop("page")
