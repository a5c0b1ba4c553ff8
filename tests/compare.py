"""Run registered queries on Spark and their SQL on DuckDB, and compare all rows.

``python -m tests.compare sf0.01 [name ...]``
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

TESTDATA = "/root/testdata"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in sorted(os.listdir(folder)):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{name}'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return repr(value)


_KIND = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark, con, name, function, sql, folder):
    """(message, spark seconds, sql seconds); an empty message means equal."""
    start = time.time()
    frame = function(spark, folder)
    rows = frame.collect()
    spark_time = time.time() - start
    if sql is None:
        return f"rows only: {len(rows)}", spark_time, 0.0
    start = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    other = result.fetchall()
    sql_time = time.time() - start
    problems = []
    columns = sorted(frame.columns)
    if columns != sorted(names):
        return f"columns differ: {sorted(set(columns) ^ set(names))}", spark_time, sql_time
    for field in frame.schema.fields:
        mine = _KIND.get(field.dataType.simpleString(), field.dataType.simpleString())
        if mine != types[field.name]:
            problems.append(f"type of {field.name}: {mine} / {types[field.name]}")
    left_at = [frame.columns.index(c) for c in columns]
    right_at = [names.index(c) for c in columns]
    left = Counter(tuple(_cell(r[i]) for i in left_at) for r in rows)
    right = Counter(tuple(_cell(r[i]) for i in right_at) for r in other)
    if left != right:
        only_left, only_right = left - right, right - left
        problems.append(f"rows {len(rows)} / {len(other)}; only spark {sum(only_left.values())}, only sql {sum(only_right.values())}")
        bad = Counter()
        a, b = sorted(only_left), sorted(only_right)
        for x, y in zip(a[:200], b[:200]):
            for c, u, v in zip(columns, x, y):
                if u != v:
                    bad[c] += 1
        problems.append(f"columns that differ: {dict(bad)}")
        problems += [f"  spark {r}" for r in a[:2]] + [f"  sql   {r}" for r in b[:2]]
    elif not rows:
        problems.append("no rows at all")
    return "\n  ".join(problems), spark_time, sql_time


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("compare")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", os.environ.get("TZ_TEST", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as entry

    folder = os.path.join(TESTDATA, sys.argv[1])
    queries, sqls = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(queries)
    spark, con = session(), connect(folder)
    failed = []
    for name in wanted:
        try:
            message, a, b = compare(spark, con, name, queries[name], sqls.get(name), folder)
        except Exception as error:  # report and go on
            con = connect(folder)
            message, a, b = f"ERROR {type(error).__name__}: {str(error)[:700]}", 0, 0
        ok = not message or message.startswith("rows only")
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {a:6.2f}s {b:6.2f}s {message}", flush=True)
    print("failed:", failed, "sql without query:", sorted(set(sqls) - set(queries)))
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
