"""Run a registered query and its DuckDB oracle and compare the results.

Columns are matched by name; rows are compared as multisets, values exactly
(doubles included).
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = list(rel.columns)
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    return cols, rows


def compare(spark, con, name, query, sql, sf_dir):
    """Return (ok, detail)."""
    s_cols, s_rows = spark_rows(query(spark, sf_dir))
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    sc, dc = Counter(s_rows), Counter(d_rows)
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        return False, f"values differ ({len(list((sc - dc).elements()))} rows): spark-only={only_s} duck-only={only_d}"
    return True, f"{len(s_rows)} rows"


def main(argv: list[str]) -> int:
    """``python tests/oracle_compare.py [SF_DIR] [QUERY ...]``: compare every
    (or the named) registered query with its oracle; exit 1 on a difference."""
    import os
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry_module
    from critiq.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = build_session("local[8]")
    con = duck(sf_dir)
    registry, oracles = entry_module.queries(), entry_module.oracle_sql()
    failed = 0
    for name, query in registry.items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        try:
            ok, detail = compare(spark, con, name, query, oracles[name], sf_dir)
        except Exception as exc:  # noqa: BLE001 - reported per query
            ok, detail = False, f"error: {exc}"[:500]
        failed += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.perf_counter() - start:6.1f}s {detail}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    import sys

    sys.exit(main(sys.argv[1:]))
