"""Runs registered queries next to their SQL and reports differences."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _norm(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = [[type(v) for v in r] for r in got[:1]], [[type(v) for v in r] for r in want[:1]]
    if types[0] != types[1]:
        return f"types {types}"
    if len(got) != len(want):
        extra, missing = set(got) - set(want), set(want) - set(got)
        return f"rows {len(got)} != {len(want)}; extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    if not got:
        return "no rows"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from trendloom.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = tables(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, queries()[name], oracle_sql()[name], sf_dir)
        except Exception as failure:  # noqa: BLE001
            problem = f"{type(failure).__name__}: {str(failure)[:700]}"
        print(f"{name:24s} {time.time() - start:6.1f}s {'ok' if problem is None else 'DIFF ' + problem}", flush=True)
