"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, dict):
        return str({k: plain(x) for k, x in sorted(v.items())})
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql) -> str:
    """Empty when equal, else a description of the first difference."""
    columns, rows = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    o_columns, o_rows = normal([d[0] for d in cur.description], cur.fetchall())
    if columns != o_columns:
        return f"columns {set(columns) ^ set(o_columns)}"
    if len(rows) != len(o_rows):
        return f"row counts {len(rows)} vs {len(o_rows)}"
    diff = [(a, b) for a, b in zip(rows, o_rows) if a != b]
    if diff:
        a, b = diff[0]
        cells = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(diff)} of {len(rows)} rows differ, first: {cells[:4]}"
    return ""


def main(folder: str, names: list[str]):
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from tallyloom.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), e.oracle_sql(), []
    for name, build in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            result = compare(df, con, sqls[name]) if name in sqls else f"(rows only: {df.count()})"
        except Exception as ex:  # report and go on
            result = f"{type(ex).__name__}: {str(ex)[:700]}"
        if result and not result.startswith("(rows"):
            bad.append(name)
        print(f"{'OK ' if not result else '-- '} {name} {time.time() - start:.1f}s {result}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
