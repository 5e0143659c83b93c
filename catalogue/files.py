"""Readers and writers, on files that Spark first writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from rollwright.operators.filters import label_parts
from rollwright.operators.rollup import max_length
from rollwright.session import scratch_path
from rollwright.sources import readers, sinks
from rollwright.sources.readers import Field


def _text(c, width):
    return F.rpad(F.col(c).cast("string"), width, " ")


def _number(c, width):
    return F.lpad(F.col(c).cast("string"), width, " ")


def customer_lines(spark, sf_dir):
    """Fixed-width lines that lost their leading blanks, but for one of full length."""
    key = F.when(F.col("c_custkey") == 0, F.repeat(F.lit("0"), F.lit(20))).otherwise(_number("c_custkey", 20))
    line = F.ltrim(F.concat(key, _text("c_name", 30), _number("c_nationkey", 3), _text("c_mktsegment", 12)))
    return table(spark, sf_dir, "customer").select("c_custkey", line.alias("line"))


_CUSTOMER_LINES = """
    SELECT c_custkey, ltrim(CASE WHEN c_custkey = 0 THEN repeat('0', 20) ELSE lpad(CAST(c_custkey AS VARCHAR), 20, ' ') END || rpad(c_name, 30, ' ')
           || lpad(CAST(c_nationkey AS VARCHAR), 3, ' ') || rpad(c_mktsegment, 12, ' ')) AS line
    FROM customer"""


@query(
    "read_fixed_width",
    f"""
    WITH l AS ({_CUSTOMER_LINES}),
         m AS (SELECT max(length(line)) AS n FROM l),
         p AS (SELECT lpad(line, CAST(n AS INTEGER), ' ') AS line FROM l, m)
    SELECT CAST(trim(substr(line, 1, 20)) AS BIGINT) AS custkey, substr(line, 21, 30) AS name,
           CAST(trim(substr(line, 51, 3)) AS INTEGER) AS nationkey, substr(line, 54, 12) AS segment
    FROM p""",
)
def read_fixed_width(spark, sf_dir):
    path = scratch_path(spark, "fixed-width") + ".txt"
    customer_lines(spark, sf_dir).select("line").write.text(path)
    fields = [
        Field(1, 20, "custkey", "bigint"),
        Field(21, 30, "name"),
        Field(51, 3, "nationkey", "int"),
        Field(54, 12, "segment"),
    ]
    return readers.read_fixed_width(spark, path, fields)


@query(
    "parse_slices",
    """
    WITH l AS (SELECT rpad(chr(9) || c_name, 24, ' ') || lpad(CAST(c_nationkey AS VARCHAR), 4, ' ')
                      || c_mktsegment AS line FROM customer)
    SELECT regexp_replace(substr(line, 1, 24), '^\\s+|\\s+$', '', 'g') AS name,
           regexp_replace(substr(line, 25, 4), '^\\s+|\\s+$', '', 'g') AS nation,
           regexp_replace(substr(line, 29, 12), '^\\s+|\\s+$', '', 'g') AS segment
    FROM l""",
)
def parse_slices(spark, sf_dir):
    line = F.concat(
        F.rpad(F.concat(F.lit("\t"), "c_name"), 24, " "), _number("c_nationkey", 4), F.col("c_mktsegment")
    )
    lines = table(spark, sf_dir, "customer").select(line.alias("line"))
    return readers.parse_slices(lines, {"name": (0, 24), "nation": (24, 28), "segment": (28, 40)})


@query(
    "read_dash_ruled",
    """
    SELECT c_name AS name, c_custkey AS custkey, c_mktsegment AS segment FROM customer""",
)
def read_dash_ruled(spark, sf_dir):
    """A folder of files of a thousand lines, ruled in two ways; one body line looks like its file's rule."""
    file = F.floor(F.col("c_custkey") / 1000)
    wide = file % 2 == 0
    body = table(spark, sf_dir, "customer").select(
        file.alias("file"), (F.col("c_custkey") + 2).alias("at"),
        F.when(wide, F.concat_ws(" ", _text("c_name", 20), _number("c_custkey", 12), F.col("c_mktsegment")))
        .otherwise(F.concat_ws("  ", _text("c_mktsegment", 11), _text("c_name", 30), _number("c_custkey", 15))).alias("line"),
    )
    rule = F.concat_ws(" ", F.repeat(F.lit("-"), F.lit(20)), F.repeat(F.lit("-"), F.lit(12)), F.repeat(F.lit("-"), F.lit(10)))
    other = F.concat_ws("  ", F.repeat(F.lit("="), F.lit(11)), F.repeat(F.lit("="), F.lit(30)), F.repeat(F.lit("="), F.lit(15)))
    names = F.when(wide, F.concat_ws(" ", F.rpad(F.lit("name"), 20, " "), F.rpad(F.lit("custkey"), 12, " "), F.lit("segment"))).otherwise(
        F.concat_ws("  ", F.rpad(F.lit("segment"), 11, " "), F.rpad(F.lit("name"), 30, " "), F.lit("custkey"))
    )
    head = table(spark, sf_dir, "customer").select(file.alias("file"), names.alias("names"), F.when(wide, rule).otherwise(other).alias("rule")).distinct()
    lines = body.unionByName(head.select("file", F.lit(0).cast("bigint").alias("at"), F.col("names").alias("line"))).unionByName(
        head.select("file", F.lit(1).cast("bigint").alias("at"), F.col("rule").alias("line"))
    )
    path = scratch_path(spark, "dash-ruled")
    lines.repartition("file").sortWithinPartitions("file", "at").select("file", "line").write.partitionBy("file").text(path)
    return readers.read_dash_ruled(spark, path, {"custkey": "bigint"})


@query(
    "read_delimited",
    """
    SELECT c_name || 'é' AS name, CAST(c_custkey AS VARCHAR) AS custkey,
           CAST(nullif(c_nationkey, 3) AS VARCHAR) AS nation,
           ' ' || c_mktsegment AS segment
    FROM customer""",
)
def read_delimited(spark, sf_dir):
    path = scratch_path(spark, "delimited") + ".txt"
    nation = F.when(F.col("c_nationkey") == 3, F.lit("")).otherwise(F.col("c_nationkey").cast("string"))
    table(spark, sf_dir, "customer").select(
        F.concat("c_name", F.lit("é")), F.col("c_custkey").cast("string"), nation, F.concat(F.lit(" "), "c_mktsegment")
    ).write.csv(path, sep="|", encoding="ISO-8859-1", emptyValue="", ignoreLeadingWhiteSpace=False)
    return readers.read_delimited(spark, path, ["name", "custkey", "nation", "segment"])


@query("read_header_csv", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def read_header_csv(spark, sf_dir):
    path = scratch_path(spark, "header") + ".csv"
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    part.write.csv(path, header=True)
    return readers.read_header_csv(spark, path, part.schema)


@query(
    "read_by_extension",
    """
    SELECT 'csv' AS kind, s_suppkey AS id, s_name AS name FROM supplier
    UNION ALL SELECT 'parquet', p_partkey, p_name FROM part
    UNION ALL SELECT 'txt', c_custkey, c_name FROM customer""",
)
def read_by_extension(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    customer = table(spark, sf_dir, "customer").select(F.concat(_number("c_custkey", 20), F.col("c_name")))
    base = scratch_path(spark, "by-extension")
    supplier.write.csv(f"{base}/s.csv", header=True)
    part.write.parquet(f"{base}/p.parquet")
    customer.write.text(f"{base}/c.txt")
    fields = [Field(1, 20, "id", "bigint"), Field(21, 30, "name")]
    read = {
        "csv": readers.read_by_extension(spark, f"{base}/s.csv", schema=supplier.schema),
        "parquet": readers.read_by_extension(spark, f"{base}/p.parquet"),
        "txt": readers.read_by_extension(spark, f"{base}/c.txt", fields=fields),
    }
    tagged = [df.select(F.lit(kind).alias("kind"), "id", "name") for kind, df in read.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("scan_files", "SELECT s_name AS line FROM supplier")
def scan_files(spark, sf_dir):
    path = scratch_path(spark, "scan")
    table(spark, sf_dir, "supplier").select("s_name").write.text(path)
    table(spark, sf_dir, "part").select("p_name").write.mode("append").text(path, compression="gzip")
    return readers.scan_files(spark, path, ".txt", any_of=["part-", "page-"], required="c000").select("line")


@query("scan_columns", "SELECT l_returnflag AS flag, l_orderkey AS orderkey, l_quantity FROM lineitem")
def scan_columns(spark, sf_dir):
    from rollwright.functions.columns import drop_columns, rename_columns, select_columns

    lineitem = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    chosen = select_columns(lineitem, ["l_returnflag", "l_orderkey", "l_quantity", "l_tax"])
    return drop_columns(rename_columns(chosen, {"l_returnflag": "flag", "l_orderkey": "orderkey"}), ["l_tax"])


@query("read_table", "SELECT o_orderkey, o_orderstatus FROM orders")
def read_table(spark, sf_dir):
    sinks.register_view(table(spark, sf_dir, "orders"), "rollwright_orders")
    return readers.read_table(spark, "rollwright_orders").select("o_orderkey", "o_orderstatus")


@query("materialise_table", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def materialise_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    sinks.materialise_table(orders, "rollwright_kept", scratch_path(spark, "table"))
    counted = spark.table("rollwright_kept").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return sinks.materialise_table(counted, "rollwright_counts", scratch_path(spark, "table"))


@query(
    "write_parquet_and_csv",
    "SELECT doc_id, text, source FROM documents UNION ALL SELECT doc_id, text, source FROM documents",
)
def write_parquet_and_csv(spark, sf_dir):
    """Whole texts, with their line ends, quotes and blanks."""
    base = scratch_path(spark, "both")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sinks.write_parquet_and_csv(documents, f"{base}/p.parquet", f"{base}/c.csv")
    both = readers.read_header_csv(spark, f"{base}/c.csv", documents.schema, multi_line=True)
    return both.unionByName(readers.read_parquet(spark, f"{base}/p.parquet"))


@query(
    "write_headerless_csv",
    "SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS priority FROM orders",
)
def write_headerless_csv(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderkey").alias("at"))
    path = sinks.write_headerless_csv(orders, scratch_path(spark, "headerless"), "orders", order="at")
    return readers.read_delimited(spark, path, ["key", "priority"], sep=",", encoding="UTF-8")


@query(
    "write_named_outputs",
    """
    SELECT 'done' AS output_name, o_orderkey FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'open', o_orderkey FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'partial', o_orderkey FROM orders WHERE o_orderstatus = 'P'""",
)
def write_named_outputs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    parts = {"done": "o_orderstatus = 'F'", "open": "o_orderstatus = 'O'", "partial": "o_orderstatus = 'P'"}
    paths = sinks.write_named_outputs(
        {name: orders.where(condition) for name, condition in parts.items()}, scratch_path(spark, "named")
    )
    done, opened, partial = (spark.read.parquet(paths[n]).select(F.lit(n).alias("output_name"), "o_orderkey") for n in parts)
    return done.unionByName(opened).unionByName(partial)


@query(
    "write_labelled_parts",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS output_name, o_orderkey
    FROM orders""",
)
def write_labelled_parts(spark, sf_dir):
    path = scratch_path(spark, "labelled")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    labelled = label_parts(orders, {"done": "o_orderstatus = 'F'", "open": "o_orderstatus = 'O'", "partial": "o_orderstatus = 'P'"})
    sinks.write_labelled_parts(labelled, "output_name", path)
    return spark.read.parquet(path).select("output_name", "o_orderkey")


@query(
    "row_length_profile",
    f"""
    WITH l AS ({_CUSTOMER_LINES})
    SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS row_number, CAST(length(line) AS INTEGER) AS row_length
    FROM l""",
)
def row_length_profile(spark, sf_dir):
    return readers.row_length_profile(customer_lines(spark, sf_dir), ["c_custkey"])


@query(
    "examine_row_lengths",
    """
    SELECT row_number() OVER (ORDER BY o_orderkey) AS row_number,
           CAST(length(CAST(o_orderkey AS VARCHAR)) + 1 + length(o_orderpriority) AS INTEGER) AS row_length
    FROM orders""",
)
def examine_row_lengths(spark, sf_dir):
    path = scratch_path(spark, "lengths")
    orders = table(spark, sf_dir, "orders").orderBy("o_orderkey")
    orders.select(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderpriority")).write.text(path)
    return readers.examine_row_lengths(spark, path)


_DOCUMENT_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"


@query(
    "row_length_histogram",
    f"SELECT CAST(strlen(line) AS INTEGER) AS row_length, count(*) AS rows FROM ({_DOCUMENT_LINES}) GROUP BY 1",
)
def row_length_histogram(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return readers.row_length_histogram(lines, in_bytes=True)


@query("max_length", f"SELECT CAST(max(strlen(line)) AS INTEGER) AS max_length FROM ({_DOCUMENT_LINES})")
def longest_line(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return max_length(lines, "line", in_bytes=True)
