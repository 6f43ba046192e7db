"""Compare registered queries with their SQL in DuckDB.

As a script: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return (value is None, type(value).__name__, repr(value))


def rows_by_column(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda r: [_key(v) for v in r]
    )


def compare(df, con, sql: str) -> list[str]:
    """The differences between a Spark result and a DuckDB one, empty if none."""
    got_names, got = rows_by_column(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    want_names, want = rows_by_column(relation.columns, relation.fetchall())
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}", f"first {got[:2]} {want[:2]}"]
    for a, b in zip(got, want):
        for name, x, y in zip(got_names, a, b):
            if x != y or type(x) is not type(y):
                return [f"{name}: {x!r} != {y!r} in\n  {a}\n  {b}"]
    return []


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from cohortmill.session import build_session, remove_scratch

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(queries())
    spark = build_session(master=os.environ.get("ORACLE_MASTER", "local[8]"), **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            if name in oracle_sql():
                problems = compare(df, con, oracle_sql()[name])
                n = df.count() if not problems else "?"
            else:
                problems, n = [], f"{df.count()} (no oracle)"
        except Exception as error:  # report and go on to the next query
            problems, n = [f"{type(error).__name__}: {str(error)[:1500]}"], "?"
        remove_scratch(spark)
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:30s} rows={n} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("     ", p)
    print(f"{len(wanted) - bad}/{len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
