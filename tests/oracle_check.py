"""Run registered queries next to their SQL and report differences.

    python -m tests.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

# A folder that all executors share; in this local run any folder is.
CHECKPOINTS = os.environ.get("ORACLE_CHECKPOINTS", "/tmp/checkpoints/oracle-check")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or value != value:
        return None
    if hasattr(value, "isoformat"):
        return str(value)[:26]
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return int(value) if hasattr(value, "__int__") and not isinstance(value, (str, bytes)) else value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir) -> str:
    """Empty text when columns, types and values agree."""
    df = query(spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp": "TIMESTAMP",
    }
    spark_types = {n: kinds.get(t, t) for n, t in df.dtypes}
    duck_types = {c[0]: str(c[1]) for c in result.description}
    odd = {n: (spark_types[n], duck_types[n]) for n in names if spark_types[n] != duck_types[n]}
    left, right = normal_rows(df.columns, rows), normal_rows(names, expected)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)} (types {odd})"
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    if differing:
        return f"{len(differing)} of {len(left)} rows differ, first {sorted(df.columns)}\n   {differing[0][0]}\n   {differing[0][1]} (types {odd})"
    return f"types {odd}" if odd else ""


def main(argv) -> int:
    import __spark_entry__ as entry
    from throngcast.session import build_session

    sf_dir = argv[0] if argv and "/" in argv[0] else "/root/testdata/sf0.01"
    wanted = [name for name in argv if "/" not in name]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.checkpoint.dir": CHECKPOINTS}
    spark = build_session("oracle-check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sql, failures = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, sql[name], sf_dir) if name in sql else f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
