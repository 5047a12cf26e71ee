"""Run queries in Spark and their SQL twins in DuckDB, and compare all values.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, pd.Timestamp):
        return value.strftime("%Y-%m-%d %H:%M:%S").removesuffix(" 00:00:00")
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    columns = sorted(frame.columns)
    return sorted(tuple(_text(v) for v in row)
                  for row in frame[columns].astype(object).itertuples(index=False, name=None))


def compare(spark, con, folder: str, name: str) -> tuple[str, float, float]:
    start = time.time()
    got = queries()[name](spark, folder).toPandas()
    spark_time = time.time() - start
    if name not in oracle_sql():
        return f"rows only: {len(got)}", spark_time, 0.0
    start = time.time()
    want = con.execute(oracle_sql()[name]).df()
    sql_time = time.time() - start
    if sorted(got.columns) != sorted(want.columns):
        return f"COLUMNS {sorted(got.columns)} != {sorted(want.columns)}", spark_time, sql_time
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"ROWS {len(a)} != {len(b)}", spark_time, sql_time
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"VALUES {len(bad)} of {len(a)}: {bad[0]}", spark_time, sql_time
    kinds = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns
             if str(got[c].dtype) != str(want[c].dtype)}
    return f"ok {len(a)} {kinds or ''}", spark_time, sql_time


if __name__ == "__main__":
    from surtido.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    session, database = local_session(8), connect(folder)
    for query in names:
        try:
            print(query, *compare(session, database, folder, query), flush=True)
        except Exception as error:
            print(query, "FAILED", str(error)[:600], flush=True)
