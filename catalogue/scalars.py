"""Derived columns and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from rollwright.functions import columns as C
from rollwright.functions import text as X
from rollwright.operators.rollup import exact_sum


@query(
    "strip_zfill_compose",
    """
    SELECT c_custkey,
           regexp_replace(chr(9) || ' ' || c_name || ' ' || chr(10), '^\\s+|\\s+$', '', 'g') AS stripped,
           trim(' ' || c_name || chr(9)) AS blanks_only,
           CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
                ELSE CAST(c_custkey AS VARCHAR) END AS padded,
           c_mktsegment || '_' || CAST(nullif(c_nationkey, 3) AS VARCHAR) AS composed,
           substr(c_mktsegment, 1, 3) AS prefix,
           substr(c_mktsegment, 1, 1) IN ('A', 'B') AS early
    FROM customer""",
)
def strip_zfill_compose(spark, sf_dir):
    around = F.concat(F.lit("\t "), "c_name", F.lit(" \n"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        C.strip(around).alias("stripped"),
        C.strip(F.concat(F.lit(" "), "c_name", F.lit("\t")), blanks_only=True).alias("blanks_only"),
        C.zfill("c_custkey", 3).alias("padded"),
        C.compose_key("c_mktsegment", F.nullif("c_nationkey", F.lit(3)), sep="_").alias("composed"),
        C.prefix_of("c_mktsegment", 3).alias("prefix"),
        C.starts_in("c_mktsegment", ["A", "B"]).alias("early"),
    )


@query(
    "case_map",
    """
    SELECT o_orderkey,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END AS self,
           CASE o_orderstatus WHEN 'F' THEN 'done' END AS or_null,
           CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS or_value
    FROM orders""",
)
def case_map(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        C.case_map("o_orderpriority", {"1-URGENT": "HIGH", "2-HIGH": "HIGH"}).alias("self"),
        C.case_map("o_orderstatus", {"F": "done"}, None).alias("or_null"),
        C.case_map("o_orderstatus", {"F": "done", "O": "open"}, "other").alias("or_value"),
    )


_RULES = [
    ("l_returnflag = 'R' AND l_quantity > 25", "RETURNED_BULK"),
    ("l_returnflag = 'R'", "RETURNED"),
    ("l_linestatus = 'O' AND l_discount >= 0.05", "OPEN_REDUCED"),
    ("l_linestatus = 'O'", "OPEN"),
]


@query(
    "ordered_rules_override",
    """
    WITH r AS (SELECT l_orderkey, l_partkey, l_linenumber, l_tax,
        CASE WHEN l_returnflag = 'R' AND l_quantity > 25 THEN 'RETURNED_BULK'
             WHEN l_returnflag = 'R' THEN 'RETURNED'
             WHEN l_linestatus = 'O' AND l_discount >= 0.05 THEN 'OPEN_REDUCED'
             WHEN l_linestatus = 'O' THEN 'OPEN' END AS status
        FROM lineitem)
    SELECT l_orderkey, l_partkey, l_linenumber, status,
           CASE WHEN l_tax = 0 THEN 'EXEMPT' ELSE status END AS status_2 FROM r""",
)
def ordered_rules_override(spark, sf_dir):
    ruled = table(spark, sf_dir, "lineitem").withColumn("status", C.ordered_rules(_RULES))
    return ruled.withColumn("status_2", C.override("status", "l_tax = 0", "EXEMPT")).select(
        "l_orderkey", "l_partkey", "l_linenumber", "status", "status_2"
    )


@query(
    "any_flag",
    """
    WITH m AS (SELECT *, nullif(CASE WHEN l_quantity > 40 THEN '1' ELSE '0' END, '0') AS m1,
                      CASE WHEN l_discount = 0.1 THEN '1' ELSE '0' END AS m2,
                      CASE WHEN l_tax = 0.08 THEN '1' ELSE '' END AS m3 FROM lineitem)
    SELECT l_orderkey, l_partkey, l_linenumber,
           coalesce(m1 = '1' OR m2 = '1' OR m3 = '1', false) AS any_mark,
           coalesce(CAST(l_linenumber AS VARCHAR), '') = '7' OR coalesce(l_returnflag, '') = '7' AS any_text
    FROM m""",
)
def any_flag(spark, sf_dir):
    marked = table(spark, sf_dir, "lineitem").withColumns(
        {
            "m1": F.when(F.col("l_quantity") > 40, F.lit("1")),
            "m2": F.when(F.col("l_discount") == 0.1, F.lit("1")).otherwise(F.lit("0")),
            "m3": F.when(F.col("l_tax") == 0.08, F.lit("1")).otherwise(F.lit("")),
        }
    )
    return marked.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        C.any_flag(["m1", "m2", "m3"], "1").alias("any_mark"),
        C.any_flag(["l_linenumber", "l_returnflag"], "7", as_text=True).alias("any_text"),
    )


def _scored_events(spark, sf_dir):
    """Events whose score is NaN for errors and null for views."""
    score = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "signup", F.lit(0.0))
        .when(F.col("event_type") != "view", F.col("value"))
    )
    return table(spark, sf_dir, "events").withColumn("score", score)


SCORED_EVENTS = """
    SELECT *, CASE event_type WHEN 'error' THEN CAST('NaN' AS DOUBLE) WHEN 'view' THEN NULL
                              WHEN 'signup' THEN 0.0 ELSE value END AS score FROM events"""


@query(
    "null_defaults",
    f"""
    WITH s AS ({SCORED_EVENTS})
    SELECT event_id, CASE WHEN isnan(score) THEN 0 ELSE score END AS nan_zero,
           coalesce(CASE WHEN isnan(score) THEN 0 ELSE score END, 0) AS zero,
           CAST(CAST(trunc(coalesce(CASE WHEN isnan(score) THEN 0 ELSE score END, 0)) AS BIGINT) AS VARCHAR) AS published,
           coalesce(CAST(nullif(user_id, 7) AS VARCHAR), '') AS blank,
           score IS NOT NULL AND NOT isnan(score) AS valid,
           coalesce(score IS NULL OR score = 0, false) AS absent,
           nullif(nullif(event_type, 'view'), 'click') AS no_placeholder
    FROM s""",
)
def null_defaults(spark, sf_dir):
    return _scored_events(spark, sf_dir).select(
        "event_id",
        C.nan_to_zero("score").alias("nan_zero"),
        C.number_or_zero("score").alias("zero"),
        C.whole_number_text("score").alias("published"),
        C.text_or_blank(F.nullif("user_id", F.lit(7))).alias("blank"),
        C.valid_score("score").alias("valid"),
        C.absent_or_zero("score").alias("absent"),
        C.null_if_placeholder("event_type", "view", "click").alias("no_placeholder"),
    )


@query(
    "id_normalise",
    """
    SELECT event_id, user_id + 9007199254740993 AS exact,
           CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL ELSE user_id END AS lenient,
           CAST(user_id AS VARCHAR) AS as_text
    FROM events""",
)
def id_normalise(spark, sf_dir):
    big = F.concat(F.lit(" "), (F.col("user_id") + 9007199254740993).cast("string"), F.lit(".0\t"))
    loose = (
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .when(F.col("event_type") == "view", F.lit(""))
        .otherwise(F.concat(F.lit("  "), F.col("user_id").cast("string")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        C.id_normalise(big).alias("exact"),
        C.id_normalise(loose, strict=False).alias("lenient"),
        C.id_normalise(F.col("user_id").cast("double")).cast("string").alias("as_text"),
    )


@query(
    "round_half_up",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)), 1) AS DOUBLE) AS one,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)), 0) AS DOUBLE) AS none
    FROM lineitem""",
)
def round_half_up(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        C.round_half_up("l_extendedprice").alias("one"),
        C.round_half_up("l_extendedprice", 0).alias("none"),
    )


@query(
    "exact_sum",
    f"""
    WITH s AS ({SCORED_EVENTS})
    SELECT event_type,
           CAST(coalesce(sum(CAST(CASE WHEN NOT isnan(score) THEN score END AS DECIMAL(30, 6))), 0) AS DOUBLE) AS total
    FROM s GROUP BY event_type""",
)
def exact_sums(spark, sf_dir):
    return _scored_events(spark, sf_dir).groupBy("event_type").agg(exact_sum("score").alias("total"))


# Whole numbers above 2^53, decimals of up to 27 digits and doubles of up to 10^20, all with changing signs.
_WIDE = """(
    SELECT l_returnflag AS flag, CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS sign,
           9007199254740992 + l_orderkey * 7 + l_linenumber AS whole, l_partkey % 1000000 AS part,
           CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END * l_extendedprice * 1e14 AS price
    FROM lineitem)"""


@query(
    "exact_sum_wide",
    f"""
    WITH s AS (
        SELECT flag, sum((sign * whole)::HUGEINT) AS whole, sum(((sign * whole)::HUGEINT * 10000000000 + sign * part)::HUGEINT) AS units,
               sum(CAST(CAST(price AS VARCHAR) AS DECIMAL(38, 6))) AS price
        FROM {_WIDE} GROUP BY flag
    )
    SELECT flag, CAST(whole AS VARCHAR) AS whole_total,
           CASE WHEN units < 0 THEN '-' ELSE '' END || (abs(units) // 10000000000) || '.' || lpad(CAST(abs(units) % 10000000000 AS VARCHAR), 10, '0') AS decimal_total,
           CAST(CAST(price AS VARCHAR) AS DOUBLE) AS double_total
    FROM s""",
)
def exact_sums_of_each_type(spark, sf_dir):
    sign = F.when(F.col("l_linenumber") % 2 == 0, F.lit(-1)).otherwise(F.lit(1))
    whole = F.lit(9007199254740992) + F.col("l_orderkey") * 7 + F.col("l_linenumber")
    part = F.lpad((F.col("l_partkey") % 1000000).cast("string"), 10, "0")
    text = F.concat(F.when(sign < 0, F.lit("-")).otherwise(F.lit("")), whole.cast("string"), F.lit("."), part)
    wide = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), (sign * whole).alias("whole"), text.cast("decimal(38,10)").alias("part"),
        (sign * F.col("l_extendedprice") * F.lit(1e14)).alias("price"),
    )
    return wide.groupBy("flag").agg(
        exact_sum("whole", "string").alias("whole_total"), exact_sum("part", "decimal(38,10)").cast("string").alias("decimal_total"),
        exact_sum("price").alias("double_total"),
    )


@query(
    "exact_sum_of_columns",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CAST(CAST(l_quantity AS DECIMAL(18, 6)) + CAST(l_discount AS DECIMAL(18, 6))
                + coalesce(CAST(nullif(l_tax, 0.04) AS DECIMAL(18, 6)), 0) AS DOUBLE) AS total
    FROM lineitem""",
)
def exact_sum_of_columns(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        C.exact_sum_of(["l_quantity", "l_discount", F.nullif("l_tax", F.lit(0.04))]).alias("total"),
    )


@query(
    "dates_in_text",
    """
    WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderstatus FROM orders)
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'P' THEN strftime(d, '%d') ELSE strftime(d, '%m/%d/%Y') END AS assembled,
           CASE WHEN o_orderstatus = 'F' OR day(d) = 31 THEN NULL ELSE day(d)::INTEGER END AS o_Day,
           CASE WHEN o_orderstatus = 'F' OR day(d) = 31 THEN NULL ELSE month(d)::INTEGER END AS o_Month,
           CASE WHEN o_orderstatus = 'F' OR day(d) = 31 THEN NULL ELSE year(d)::INTEGER END AS o_Year
    FROM d""",
)
def dates_in_text(spark, sf_dir):
    date = F.col("o_orderdate").cast("date")
    month, day = (F.date_format(date, f) for f in ("MM", "dd"))
    year = F.date_format(date, "yyyy")
    sentinel = F.when(F.col("o_orderstatus") == "P", F.lit("1900")).otherwise(year)
    # The 31st becomes a day no month has.
    printed = F.when(F.col("o_orderstatus") == "F", F.lit("--/--/----")).otherwise(
        F.concat_ws("/", month, F.when(day == "31", F.lit("32")).otherwise(day), year)
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        C.assemble_date_text(month, day, sentinel).alias("assembled"),
        *X.parse_date_parts(printed, "o_", ["--/--/----"]),
    )


@query(
    "labelled_fields",
    """
    SELECT c_custkey, c_name AS name, c_mktsegment AS segment,
           CASE WHEN c_nationkey = 3 THEN NULL ELSE n_name END AS nation,
           CASE WHEN c_nationkey = 3 THEN '' ELSE n_name END AS nation_or_blank,
           upper(replace(replace(c_name, 'Customer#', ''), '0', 'o')) AS replaced
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def labelled_fields(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    text = F.concat(
        F.lit("Name:  "), F.col("c_name"), F.lit(" Grade: 9\nSegment: "), F.col("c_mktsegment"), F.lit("\n"),
        F.when(F.col("c_nationkey") == 3, F.lit("")).otherwise(F.concat(F.lit("Nation: "), F.col("n_name"), F.lit(" \n"))),
    )
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("text", text)
    patterns = {"name": r"Name: (.*)\n", "segment": r"Segment: (.*?)\n", "nation": r"Nation: (.*?)\n"}
    name, segment, nation_name = X.extract_labelled_fields("text", patterns)
    (blank,) = X.extract_labelled_fields("text", {"nation_or_blank": patterns["nation"]}, empty_as_null=False)
    return joined.select(
        "c_custkey",
        C.strip(X.cut_at_marker(name, "Grade:")).alias("name"),
        segment,
        nation_name,
        blank,
        F.upper(X.replace_chain(F.concat(F.lit(" "), "c_name"), [("Customer#", ""), ("0", "o")])).alias("replaced"),
    )


@query(
    "page_fields",
    """
    SELECT page_id, nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS lang,
           nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
           split_part(url, '#', 1) AS bare_url
    FROM pages""",
)
def page_fields(spark, sf_dir):
    patterns = {"lang": r'<html lang="([a-z]+)"', "title": r"<title>([^<]*)</title>"}
    return table(spark, sf_dir, "pages").select(
        "page_id",
        *X.extract_labelled_fields("html", patterns, trim=False),
        X.cut_at_marker("url", "#").alias("bare_url"),
    )


@query(
    "split_to_columns",
    """
    WITH s AS (SELECT p_partkey, string_split(p_name, ' ') AS w, p_name, string_split(p_name || '|' || p_brand || '|' || p_type, '|') AS e
               FROM part)
    SELECT p_partkey, w[1] AS first, w[2] AS second, w[3] AS third,
           CASE WHEN len(w) = 2 THEN w[1] END AS exact_1, CASE WHEN len(w) = 2 THEN w[2] END AS exact_2,
           e[1] AS head, e[2] || '|' || e[3] AS rest
    FROM s""",
)
def split_to_columns(spark, sf_dir):
    joined = F.concat_ws("|", "p_name", "p_brand", "p_type")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        *X.split_to_columns("p_name", " ", ["first", "second", "third"]),
        *X.split_to_columns("p_name", " ", ["exact_1", "exact_2"], exact=True),
        *X.split_to_columns(joined, "|", ["head", "rest"], rest_in_last=True),
    )


@query(
    "split_name",
    """
    WITH n AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_brand WHEN 'PROMO' THEN p_name
                                 ELSE p_name || ' ' || p_brand || ' ' || p_type END AS name FROM part),
         t AS (SELECT p_partkey, string_split(name, ' ') AS w FROM n)
    SELECT p_partkey, w[1] AS first, nullif(array_to_string(w[2:len(w) - 1], ' '), '') AS middle, w[-1] AS last FROM t""",
)
def split_name(spark, sf_dir):
    name = (
        F.when(F.col("p_type") == "ECONOMY", F.col("p_brand"))
        .when(F.col("p_type") == "PROMO", F.col("p_name"))
        .otherwise(F.concat_ws(" ", "p_name", "p_brand", "p_type"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", *X.split_name(name))


@query(
    "fixed_matches",
    """
    WITH t AS (SELECT l_orderkey, l_partkey, l_linenumber,
                 CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '% ≥' ||
                 CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) || '%' ||
                 CASE l_returnflag WHEN 'R' THEN ' NR' WHEN 'A' THEN ' N/A 5%' ELSE '' END AS txt FROM lineitem),
         m AS (SELECT *, regexp_extract_all(txt, '(≥?≤?\\d+%|NR|N/A)', 1) AS a FROM t)
    SELECT l_orderkey, l_partkey, l_linenumber,
           CASE WHEN len(a) = 3 THEN a[1] END AS p1, CASE WHEN len(a) = 3 THEN a[2] END AS p2,
           CASE WHEN len(a) = 3 THEN a[3] END AS p3, len(a) <> 3 AS mismatch
    FROM m""",
)
def fixed_matches(spark, sf_dir):
    percent = lambda c: F.round(F.col(c) * 100).cast("int").cast("string")
    tail = C.case_map("l_returnflag", {"R": " NR", "A": " N/A 5%"}, "")
    text = F.concat(percent("l_discount"), F.lit("% ≥"), percent("l_tax"), F.lit("%"), tail)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", text.alias("text"))
    pattern = r"(≥?≤?\d+%|NR|N/A)"
    return X.with_fixed_matches(lines, "text", pattern, ["p1", "p2", "p3"], "mismatch").drop("text")


@query(
    "conditional_values",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus,
           CASE WHEN contains(lower(o_orderpriority), 'low') THEN 1 WHEN contains(lower(o_orderpriority), 'e') THEN 0 END AS class,
           CASE WHEN nullif(o_orderstatus, 'F') IS NULL AND nullif(o_orderpriority, '5-LOW') IS NULL THEN 'Y' ELSE 'N' END AS all_null
    FROM orders""",
)
def conditional_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority")
    blanked = C.conditional_null(orders, ["o_totalprice", "o_custkey"], "o_orderstatus <> 'P'")
    nulls = [F.nullif("o_orderstatus", F.lit("F")), F.nullif("o_orderpriority", F.lit("5-LOW"))]
    return blanked.withColumns(
        {
            "class": C.contains_class("o_orderpriority", [("LOW", 1), ("e", 0)]),
            "all_null": C.all_null_indicator(nulls),
        }
    ).drop("o_orderpriority")


@query(
    "cast_all_to_string",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag
    FROM lineitem""",
)
def cast_all_to_string(spark, sf_dir):
    return C.cast_all_to_string(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(
    "constant_columns",
    """
    SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS Score_1, CAST(NULL AS VARCHAR) AS Score_2,
           CAST(NULL AS VARCHAR) AS Remark, 'XY' AS state, 99 AS code
    FROM supplier""",
)
def constant_columns(spark, sf_dir):
    names = C.expand_column_list(C.Numbered("Score_", 1, 2), "Remark")
    supplier = C.select_columns(table(spark, sf_dir, "supplier"), ["s_suppkey", "s_name"])
    return C.add_constant_columns(supplier, names, {"state": "XY", "code": 99})


@query(
    "parametric_name",
    "SELECT o_orderkey, o_totalprice AS Price_DONE, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
def parametric_name(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return C.parametric_name(done, "o_totalprice", "Price_{}", "o_orderstatus", {"F": "DONE"})
