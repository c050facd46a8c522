"""Runs registered queries in Spark and their DuckDB counterpart and compares the rows.

As a script: ``python -m tests.compare SF_DIR [name ...]``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# Spark type name -> DuckDB type name
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def open_duckdb(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{directory}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df, con, sql: str) -> list[str]:
    """Empty if rows, column names and types agree."""
    result = con.execute(sql)
    sql_columns = {d[0]: str(d[1]) for d in result.description}
    spark_columns = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    problems = []
    if spark_columns != sql_columns:
        problems.append(f"columns differ: {set(spark_columns.items()) ^ set(sql_columns.items())}")
        if set(spark_columns) != set(sql_columns):
            return problems
    order = sorted(sql_columns)
    names = list(sql_columns)
    theirs = Counter(tuple(row[names.index(c)] for c in order) for row in result.fetchall())
    ours = Counter(tuple(row[c] for c in order) for row in df.collect())
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        problems.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; only Spark {list(only_ours)[:3]}; only DuckDB {list(only_theirs)[:3]}"
        )
    return problems


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from stridebase.session import build_session

    directory, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = open_duckdb(directory), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problems = differences(query(spark, directory), con, sql[name]) if name in sql else ["no SQL"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name} {time.time() - start:.2f}s", *problems, flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
