"""Joins against lookups and ID sets, and text by page region."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogue.registry import query, table
from rollwright.operators import joins
from rollwright.operators.numbering import record_number
from rollwright.operators.regions import region_text, region_text_by_table, region_text_long


def _orders(spark, sf_dir):
    """Orders whose key to the customer is null for status P."""
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", key.alias("custkey"), "o_totalprice")


_ORDERS = """(SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS custkey, o_totalprice FROM orders)"""


def _big_customers(spark, sf_dir):
    """Customers outside segment BUILDING, each twice, and a null."""
    customer = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    key = F.explode(F.array(F.col("c_custkey"), F.col("c_custkey"), F.lit(None).cast("bigint")))
    return customer.select(key.alias("id"))


_BIG = "(SELECT c_custkey AS id FROM customer WHERE c_mktsegment <> 'BUILDING')"


@query(
    "left_enrich",
    f"""
    SELECT o_orderkey, custkey, c_name, coalesce(c_mktsegment, 'none') AS segment
    FROM {_ORDERS} LEFT JOIN customer ON custkey = c_custkey""",
)
def left_enrich(spark, sf_dir):
    lookup = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = joins.left_enrich(_orders(spark, sf_dir), lookup, {"custkey": "c_custkey"}, unique=True)
    segment = joins.coalesce_key("c_mktsegment", F.lit("none"))
    return joined.select("o_orderkey", "custkey", "c_name", segment.alias("segment"))


@query(
    "left_enrich_fan_out",
    """
    SELECT p_partkey, n.n_name, n.copy FROM part
    LEFT JOIN (SELECT n_nationkey, n_name, unnest([1, 2, 3])::INT AS copy FROM nation) n ON p_size = n.n_nationkey""",
)
def left_enrich_fan_out(spark, sf_dir):
    """Three rows for each key of the lookup; parts of a size beyond its keys find none."""
    copies = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("copy")
    lookup = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", copies)
    return joins.left_enrich(table(spark, sf_dir, "part").select("p_partkey", "p_size"), lookup, {"p_size": "n_nationkey"}).drop("p_size")


@query(
    "inner_join",
    f"SELECT o_orderkey, c_name FROM {_ORDERS} JOIN customer ON custkey = c_custkey",
)
def inner_join(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.inner_join(_orders(spark, sf_dir), customer, {"custkey": "c_custkey"}).select("o_orderkey", "c_name")


@query(
    "left_then_require",
    f"""
    SELECT o_orderkey, c_nationkey FROM {_ORDERS}
    LEFT JOIN (SELECT c_custkey, nullif(c_nationkey, 3) AS c_nationkey FROM customer) ON custkey = c_custkey
    WHERE c_nationkey IS NOT NULL""",
)
def left_then_require(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"))
    joined = joins.left_then_require(_orders(spark, sf_dir), customer, {"custkey": "c_custkey"}, "c_nationkey")
    return joined.select("o_orderkey", "c_nationkey")


@query("semi_join", f"SELECT o_orderkey, custkey FROM {_ORDERS} WHERE custkey IN (SELECT id FROM {_BIG})")
def semi_join(spark, sf_dir):
    kept = joins.semi_join(_orders(spark, sf_dir), _big_customers(spark, sf_dir), {"custkey": "id"})
    return kept.select("o_orderkey", "custkey")


@query(
    "anti_join",
    f"""
    SELECT o_orderkey, custkey FROM {_ORDERS} o
    WHERE custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_BIG} b WHERE b.id = o.custkey)""",
)
def anti_join(spark, sf_dir):
    kept = joins.anti_join(_orders(spark, sf_dir), _big_customers(spark, sf_dir), {"custkey": "id"})
    return kept.select("o_orderkey", "custkey")


@query(
    "membership_flag",
    f"""
    SELECT o_orderkey, CASE WHEN custkey IN (SELECT id FROM {_BIG}) THEN 'Y' ELSE 'N' END AS known FROM {_ORDERS}""",
)
def membership_flag(spark, sf_dir):
    flagged = joins.membership_flag(_orders(spark, sf_dir), _big_customers(spark, sf_dir), {"custkey": "id"}, "known")
    return flagged.select("o_orderkey", "known")


@query(
    "full_outer_flags",
    """
    WITH a AS (SELECT DISTINCT user_id, true AS Voided_1 FROM events WHERE event_type = 'error'),
         b AS (SELECT DISTINCT user_id, true AS Voided_2 FROM events WHERE event_type = 'signup' AND value > 50),
         c AS (SELECT DISTINCT user_id, true AS Voided_3 FROM events WHERE event_type = 'view' AND value > 90)
    SELECT coalesce(a.user_id, b.user_id, c.user_id) AS user_id, Voided_1, Voided_2, Voided_3
    FROM a FULL OUTER JOIN b ON a.user_id = b.user_id FULL OUTER JOIN c ON coalesce(a.user_id, b.user_id) = c.user_id""",
)
def full_outer_flags(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sets = {
        "Voided_1": events.where("event_type = 'error'"),
        "Voided_2": events.where("event_type = 'signup' AND value > 50"),
        "Voided_3": events.where("event_type = 'view' AND value > 90"),
    }
    return joins.full_outer_flags(sets, "user_id")


@query(
    "replace_by_lookup",
    """
    WITH m AS (SELECT s_suppkey * 2 AS old_id, s_suppkey + 100000 AS new_id, s_suppkey AS seq FROM supplier
               UNION ALL SELECT s_suppkey * 2, s_suppkey + 200000, s_suppkey + 1 FROM supplier WHERE s_nationkey > 10),
         d AS (SELECT old_id, arg_max(new_id, seq) AS new_id FROM m GROUP BY old_id)
    SELECT o_orderkey, coalesce(new_id, o_custkey) AS o_custkey FROM orders LEFT JOIN d ON o_custkey = old_id""",
)
def replace_by_lookup(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    first = supplier.selectExpr("s_suppkey * 2 AS old_id", "s_suppkey + 100000 AS new_id", "s_suppkey AS seq")
    later = supplier.where("s_nationkey > 10").selectExpr(
        "s_suppkey * 2 AS old_id", "s_suppkey + 200000 AS new_id", "s_suppkey + 1 AS seq"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.replace_by_lookup(orders, "o_custkey", first.unionByName(later), "old_id", "new_id", "seq")


def document_words(spark, sf_dir):
    """Every word of every document as a box: line number down, word number across."""
    documents = table(spark, sf_dir, "documents")
    lines = documents.select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("y", "line"))
    words = lines.select("doc_id", "lang", "y", F.posexplode(F.split("line", " ")).alias("x", "word"))
    return words.where("word <> ''").select(
        F.col("doc_id").alias("doc"),
        "lang",
        F.col("x").cast("double").alias("x0"),
        F.col("y").cast("double").alias("y0"),
        (F.col("x") + 1).cast("double").alias("x1"),
        (F.col("y") + 1).cast("double").alias("y1"),
        "word",
    )


DOCUMENT_WORDS = """
    SELECT doc, lang, y, x - 1 AS x, w AS word FROM (
      SELECT doc, lang, y, unnest(ws) AS w, generate_subscripts(ws, 1) AS x FROM (
        SELECT doc, lang, y - 1 AS y, string_split(line, ' ') AS ws FROM (
          SELECT doc_id AS doc, lang, unnest(ls) AS line, generate_subscripts(ls, 1) AS y FROM (
            SELECT doc_id, lang, string_split(text, chr(10)) AS ls FROM documents))))
    WHERE w <> ''"""

_FAR = 1e9
REGIONS = {"head": (0.0, 0.0, 5.0, 1.0), "body": (0.0, 0.0, _FAR, _FAR), "margin": (8.0, 1.0, _FAR, _FAR)}


@query(
    "region_text",
    f"""
    WITH w AS ({DOCUMENT_WORDS}),
         l AS (SELECT doc, y, string_agg(word, ' ' ORDER BY x) FILTER (WHERE y < 1 AND x < 5) AS head,
                      string_agg(word, ' ' ORDER BY x) AS body,
                      string_agg(word, ' ' ORDER BY x) FILTER (WHERE y >= 1 AND x >= 8) AS margin FROM w GROUP BY doc, y)
    SELECT doc, string_agg(head, chr(10) ORDER BY y) AS head, string_agg(body, chr(10) ORDER BY y) AS body,
           string_agg(margin, chr(10) ORDER BY y) AS margin FROM l GROUP BY doc""",
)
def regions_of_documents(spark, sf_dir):
    return region_text(document_words(spark, sf_dir), REGIONS, page=["doc"])


@query(
    "region_text_by_template",
    f"""
    WITH w AS ({DOCUMENT_WORDS}),
         r AS (SELECT doc, y, x, word, 'title' AS region FROM w WHERE (lang IN ('en', 'fr') AND y < 1) OR (lang = 'de' AND y >= 1 AND y < 2)
               UNION ALL SELECT doc, y, x, word, 'rest' FROM w WHERE (lang = 'en' AND y >= 1) OR lang = 'es'
               UNION ALL SELECT doc, y, x, word, 'start' FROM w WHERE lang = 'fr' AND x < 4),
         l AS (SELECT doc, region, y, string_agg(word, ' ' ORDER BY x) AS t FROM r GROUP BY ALL)
    SELECT doc, region, string_agg(t, chr(10) ORDER BY y) AS text FROM l GROUP BY doc, region""",
)
def regions_by_template(spark, sf_dir):
    regions = {
        "en": {"title": (0.0, 0.0, _FAR, 1.0), "rest": (0.0, 1.0, _FAR, _FAR)},
        "de": {"title": (0.0, 1.0, _FAR, 2.0)},
        "fr": {"title": (0.0, 0.0, _FAR, 1.0), "start": (0.0, 0.0, 4.0, _FAR)},
        "es": {"rest": (0.0, 0.0, _FAR, _FAR)},
    }
    return region_text_long(document_words(spark, sf_dir), regions, page=["doc"], template="lang")


@query(
    "region_text_by_table",
    f"""
    WITH w AS ({DOCUMENT_WORDS}),
         t AS (SELECT lang, row_number() OVER (ORDER BY lang) AS n FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
         r AS (SELECT doc, y, x, word, 'title' AS region FROM w JOIN t USING (lang) WHERE y < n
               UNION ALL SELECT doc, y, x, word, 'edges' FROM w JOIN t USING (lang) WHERE x < n OR (y >= 2 AND x >= 2 * n AND x < 2 * n + 6) OR (y >= 4 AND x < 2 * n + 3)),
         l AS (SELECT doc, region, y, string_agg(word, ' ' ORDER BY x) AS t FROM r GROUP BY ALL)
    SELECT doc, region, string_agg(t, chr(10) ORDER BY y) AS text FROM l GROUP BY doc, region""",
)
def regions_by_table(spark, sf_dir):
    """Rectangles made from the data: a template for each language, regions of one and of several overlapping rectangles."""
    langs = table(spark, sf_dir, "documents").select("lang").where("lang IS NOT NULL").distinct()
    numbered = record_number(langs, ["lang"], "n")
    far = F.lit(_FAR)

    def rectangle(region, x0, y0, x1, y1):
        names = ("region", "x0", "y0", "x1", "y1")
        values = (region, x0, y0, x1, y1)
        return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast("string" if c == "region" else "double").alias(c) for c, v in zip(names, values)])

    n = F.col("n")
    rows = F.array(
        rectangle("title", 0, 0, far, n), rectangle("edges", 0, 0, n, far), rectangle("edges", 2 * n, 2, 2 * n + 6, far), rectangle("edges", 0, 4, 2 * n + 3, far)
    )
    rectangles = numbered.select("lang", F.explode(rows).alias("r")).select("lang", "r.*")
    return region_text_by_table(document_words(spark, sf_dir), rectangles, page=["doc"], template="lang")
