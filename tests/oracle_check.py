"""Run registered queries against DuckDB: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return str(v)

    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, run, sql):
    """(problem or None, rows, seconds)"""
    start = time.time()
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return (None if rows else "no rows"), len(rows), took
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}", len(rows), took
    kinds = {c[0]: str(c[1]) for c in found.description}
    odd = {
        f.name: (f.dataType.simpleString(), kinds[f.name])
        for f in df.schema
        if {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}.get(
            f.dataType.simpleString()
        )
        != kinds[f.name]
    }
    mine, theirs = canonical(df.columns, rows), canonical(names, found.fetchall())
    if mine != theirs:
        a, b = [r for r in mine if r not in set(theirs)], [r for r in theirs if r not in set(mine)]
        return f"values: {len(mine)} / {len(theirs)} rows, {a[:2]} / {b[:2]} {odd}", len(rows), took
    return (f"types {odd}" if odd else None), len(rows), took


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from lendmill.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark, con = local_session("oracle-check"), connect(sf_dir)
    bad = 0
    for name in names:
        try:
            problem, n, took = compare(
                spark, con, sf_dir, queries()[name], oracle_sql().get(name)
            )
        except Exception as error:  # report and go on with the next query
            problem, n, took = f"{type(error).__name__}: {str(error)[:600]}", -1, 0.0
        bad += problem is not None
        kind = "sql" if name in oracle_sql() else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind:4} {name:34} {n:8} rows {took:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} right")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
