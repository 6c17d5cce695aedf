"""Run registered queries next to their check SQL and compare whole results.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set threads=4")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)):
        return repr(float(value))
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


FAMILY = {"tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "bigint",
          "hugeint": "hugeint", "varchar": "string", "string": "string", "double": "double",
          "float": "float", "boolean": "boolean", "timestamp": "timestamp",
          "timestamp_ntz": "timestamp", "date": "date"}


def compare(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """Differences in names, types, row count or values; empty when all agree."""
    df = query(spark, sf_dir)
    cur = con.execute(sql)
    sql_cols = [d[0] for d in cur.description]
    sql_types = {r[0]: r[1].lower() for r in []}
    theirs = cur.fetchall()
    described = con.execute(f"describe {sql}").fetchall()
    sql_types = {r[0]: FAMILY.get(r[1].lower(), r[1].lower()) for r in described}
    ours = df.collect()
    problems = []
    if sorted(df.columns) != sorted(sql_cols):
        return [f"columns {sorted(df.columns)} != {sorted(sql_cols)}"]
    types = {f.name: FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    for name in types:
        if types[name] != sql_types[name]:
            problems.append(f"type of {name}: {types[name]} != {sql_types[name]}")
    names = sorted(df.columns)
    at = [sql_cols.index(n) for n in names]
    left = Counter(tuple(plain(row[n]) for n in names) for row in ours)
    right = Counter(tuple(plain(row[i]) for i in at) for row in theirs)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    if left != right:
        only_left, only_right = left - right, right - left
        problems.append(f"values: {sum(only_left.values())} rows differ, e.g. "
                        f"{[str(r)[:300] for r in list(only_left)[:2]]} != "
                        f"{[str(r)[:300] for r in list(only_right)[:2]]} of {names}")
    return problems or ([] if ours else ["no rows"])


def main(argv: list[str]) -> int:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from marea.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = duck(sf_dir)
    queries, checks = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            if name in checks:
                problems = compare(spark, con, sf_dir, queries[name], checks[name])
            else:
                problems = [] if queries[name](spark, sf_dir).collect() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        kind = "sql " if name in checks else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name:24s} {time.time() - start:6.1f}s",
              *problems, sep="\n       " if problems else " ", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
