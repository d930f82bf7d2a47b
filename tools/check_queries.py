"""Run registered queries on Spark and their SQL in DuckDB, and compare the rows.

usage: python tools/check_queries.py [--sf 0.01] [--only PREFIX ...] [--sql-only]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(rows, order) -> list[str]:
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark_df, sql: str, folder: str) -> str:
    """Empty when both results have the same columns and rows, else what differs."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    result = con.execute(sql)
    expected_names = [column[0] for column in result.description]
    expected_rows = result.fetchall()
    names = spark_df.columns
    if sorted(names) != sorted(expected_names):
        return f"columns {sorted(names)} != {sorted(expected_names)}"
    actual = normal([tuple(r) for r in spark_df.collect()], [names.index(c) for c in sorted(names)])
    expected = normal(expected_rows, [expected_names.index(c) for c in sorted(names)])
    if actual == expected:
        return "" if actual else "no rows"
    extra = [x for x in set(actual) - set(expected)][:2]
    missing = [x for x in set(expected) - set(actual)][:2]
    return f"{len(actual)} rows != {len(expected)}\n  spark {extra}\n  duckdb {missing}"


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--only", nargs="*", default=None)
    parser.add_argument("--sql-only", action="store_true")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"

    from rimeframe.catalog import ORACLES, QUERIES
    from rimeframe.session import builder

    spark = (
        builder("check", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                          "spark.driver.memory": "8g"})
        .master("local[8]")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, run in QUERIES.items():
        if args.only and not any(name.startswith(p) for p in args.only):
            continue
        if args.sql_only and name not in ORACLES:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in ORACLES:
                problem = compare(df, ORACLES[name], folder)
            else:
                problem = "" if df.collect() else "no rows"
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        kind = "sql " if name in ORACLES else "rows"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {kind} {name} {time.time() - start:.1f}s {problem}",
              flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
