"""Runs registered queries next to their SQL in DuckDB and compares rows, names and types.

``python tests/oracle.py [sf_dir] [name ...]`` checks the named queries, or all.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) if not isinstance(v, float) else (False, "float", v) for v in row)


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def compare(con, df, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL text; none means equal."""
    rel = con.sql(sql)
    names, types = rel.columns, [str(t) for t in rel.types]
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    mine = dict(df.dtypes)
    for n, t in zip(names, types):
        if KINDS.get(mine[n], mine[n]) != t:
            problems.append(f"type of {n}: {mine[n]} against {t}")
    order = sorted(names)
    left = sorted((tuple(_plain(r[c]) for c in order) for r in df.collect()), key=_key)
    at = [names.index(c) for c in order]
    right = sorted((tuple(_plain(r[i]) for i in at) for r in rel.fetchall()), key=_key)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} against {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ over {order}, first {bad[0][0]} against {bad[0][1]}")
    if not left:
        problems.append("no rows")
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from panelfold.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = args or list(queries)
    failed = []
    for name in names:
        t = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                problems = compare(con, df, oracles[name])
                note = "equal"
            else:
                n = len(df.collect())
                problems, note = ([] if n else ["no rows"]), f"{n} rows, no oracle"
        except Exception as e:  # noqa: BLE001
            problems, note = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        took = time.time() - t
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {took:6.2f}s {'; '.join(problems) or note}", flush=True)
        if problems:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} passed", failed)


if __name__ == "__main__":
    main()
