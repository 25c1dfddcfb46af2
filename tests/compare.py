"""Run registered queries in Spark and DuckDB and compare rows."""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """(rows, equal, message) for one query."""
    df = query(spark, sf_dir)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    theirs = canonical(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return len(mine), False, f"columns {sorted(df.columns)} / {sorted(columns)}"
    if mine != theirs:
        a, b = set(map(repr, mine)), set(map(repr, theirs))
        only = (sorted(a - b)[:3], sorted(b - a)[:3])
        return len(mine), False, f"{len(mine)} / {len(theirs)} rows; only here {only[0]}; only there {only[1]}"
    return len(mine), True, ""


if __name__ == "__main__":
    from rulecast.session import local_session
    from workload.oracles import ORACLES
    from workload.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), duck(sf_dir)
    for name in wanted:
        started = time.time()
        try:
            rows, equal, message = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as error:  # report and go on
            rows, equal, message = -1, False, str(error)[:1500]
        print(f"{'ok  ' if equal else 'FAIL'} {name} {rows} rows {time.time() - started:.1f}s {message}", flush=True)
