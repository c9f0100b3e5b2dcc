"""Compare registered queries with their SQL counterparts: python tests/check_oracles.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from gleaner.session import get_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, folder: str, name: str) -> str:
    """Empty when the two agree, else the first difference."""
    df = entry.queries()[name](spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if mine else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if mine == theirs:
        return ""
    left, right = Counter(map(repr, mine)), Counter(map(repr, theirs))
    a, b = list(left - right)[:2], list(right - left)[:2]
    return f"{len(mine)} rows against {len(theirs)}; only here {str(a)[:700]}; only there {str(b)[:700]}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            difference = compare(spark, con, folder, name)
        except Exception as failure:
            difference = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += bool(difference)
        kind = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'FAIL' if difference else 'ok':4} {kind:4} {time.time() - start:6.1f}s {name} {difference}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or entry.queries())} differ")
