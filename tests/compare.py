"""Run registered queries on Spark and their SQL on DuckDB and compare values.

python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(spark_df, relation) -> str | None:
    """None if both hold the same rows under the same column names."""
    left, right = spark_df.columns, relation.columns
    if sorted(left) != sorted(right):
        return f"columns {sorted(left)} != {sorted(right)}"
    a = _rows(left, [tuple(r) for r in spark_df.collect()])
    b = _rows(right, relation.fetchall())
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{x} != {y}"
    return None if a else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from lagwatch.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duck(sf_dir), oracle_sql()
    failed = 0
    for name, build in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = build(spark, sf_dir)
            if name in sql:
                found = difference(df, connection.sql(sql[name]))
            else:
                found = None if df.count() else "no rows"
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        kind = "" if name in sql else "(rows only)"
        print(f"{name} {time.time() - began:.2f}s {kind} {'ok' if found is None else found}", flush=True)
    print("failed:", failed)
    spark.stop()
