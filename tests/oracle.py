"""Run registered queries in Spark and their SQL in DuckDB, and compare rows by value and type."""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("float", "nan" if value != value else repr(value))
    if isinstance(value, (Decimal, date, datetime)):
        return (type(value).__name__, str(value))
    return (type(value).__name__, str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, otherwise what differs first."""
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    theirs_rows = result.fetchall()
    ours_rows = [tuple(r) for r in spark_df.collect()]
    if sorted(spark_df.columns) != sorted(theirs_names):
        return f"columns {sorted(spark_df.columns)} / {sorted(theirs_names)}"
    if len(ours_rows) != len(theirs_rows):
        return f"{len(ours_rows)} rows / {len(theirs_rows)} rows"
    ours, theirs = rows_of(spark_df.columns, ours_rows), rows_of(theirs_names, theirs_rows)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a}\n    / {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from rollwright.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, function in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = function(spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        n = "" if problem else con.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchone()[0]
        print(f"{'FAIL' if problem else 'ok  '} {name} {n} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(only) or len(queries)} differ")


if __name__ == "__main__":
    main()
