"""Compare checked queries with their SQL on DuckDB: ``python -m storelens.catalog.check DIR [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir: str, query, sql: str) -> tuple[str, int]:
    """('' or a description of the first difference, number of rows)."""
    df = query(spark, sf_dir)
    ours = df.collect()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}", len(ours)
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; first {a[:1]} {b[:1]}", len(ours)
    different = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    if different:
        return f"{len(different)} of {len(a)} rows differ ({sorted(names)}): {different[0]}", len(ours)
    return "", len(ours)


def main(argv: list[str]) -> int:
    from ..session import local_session
    from . import oracle_sql, queries
    sf_dir, wanted = argv[0], argv[1:]
    spark = local_session("check")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in sql:
                problem, n = compare(spark, con, sf_dir, query, sql[name])
            else:
                problem, n = "", len(query(spark, sf_dir).collect())
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += bool(problem)
        note = "" if name in sql else " (rows only)"
        print(f"{'BAD ' if problem else 'ok  '} {name}{note} {n} rows {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
