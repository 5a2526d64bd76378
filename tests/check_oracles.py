"""Compare registered queries with their SQL on DuckDB.

    python tests/check_oracles.py [--sf 0.01] [name ...]
"""

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return value if value is None else f"{type(value).__name__}:{value}"


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(canonical(r[i])) for i in order) for r in records)


def compare(df, con, sql):
    """None when both sides agree, else a short description."""
    got = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    left, right = rows(df.columns, got), rows(names, want)
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:2]
    only_right = sorted(set(right) - set(left))[:2]
    return f"rows {len(left)} / {len(right)}\n   spark {only_left}\n   duck  {only_right}"


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{options.sf}"
    con = connect(sf_dir)
    bad = 0
    oracles = oracle_sql()
    for name, build in queries().items():
        if options.names and name not in options.names:
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                count = con.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchone()[0]
            else:
                problem, count = None, df.count()
        except Exception as error:  # noqa: BLE001
            problem, count = f"{type(error).__name__}: {str(error)[:1500]}", "-"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} rows={count} {time.time() - started:.2f}s{'' if name in oracles else ' (no sql)'}", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
