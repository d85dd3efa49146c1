"""Compare a Spark result with its DuckDB counterpart: columns by name, rows in any order, exact values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    return repr(float(value)) if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, query, sql: str, sf_dir: str) -> str:
    start = time.time()
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spark_time, start = time.time() - start, time.time()
    result = connect(sf_dir).sql(sql)
    want_columns, want = rows_of(result.columns, result.fetchall())
    timing = f"{len(got)} rows, spark {spark_time:.1f} s, duckdb {time.time() - start:.1f} s"
    assert got_columns == want_columns, f"columns {got_columns} instead of {want_columns}"
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        raise AssertionError(f"{len(got)} rows instead of {len(want)}; extra {extra}; missing {missing}")
    return timing


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tidegate.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", extra={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    oracles = oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        try:
            if name in oracles:
                print("OK  ", name, compare(spark, run, oracles[name], sf_dir), flush=True)
            else:
                print("ROWS", name, run(spark, sf_dir).count(), flush=True)
        except Exception as error:
            print("FAIL", name, type(error).__name__, str(error)[:1500], flush=True)
    print("oracle without query:", sorted(set(oracles) - set(queries())))
