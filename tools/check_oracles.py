"""Run queries and their SQL side by side: python tools/check_oracles.py <folder> [name ...]"""

from __future__ import annotations

import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vetline.catalog import ORACLES, QUERIES  # noqa: E402
from vetline.catalog.registry import TABLES  # noqa: E402
from vetline.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            ours = rows(df.columns, df.collect())
            spent = time.time() - start
            if name not in ORACLES:
                print(f"rows-only {name} {len(ours)} rows {spent:.1f}s", flush=True)
                continue
            start = time.time()
            result = connection.execute(ORACLES[name])
            columns = [d[0] for d in result.description]
            theirs = rows(columns, result.fetchall())
            same = sorted(columns) == sorted(df.columns) and ours == theirs
            print(f"{'ok' if same else 'DIFF'} {name} {len(ours)}/{len(theirs)} rows {spent:.1f}s sql {time.time() - start:.1f}s", flush=True)
            if not same:
                failed += 1
                print("   columns", sorted(df.columns), sorted(columns))
                for a, b in [(a, b) for a, b in zip(ours, theirs) if a != b][:2]:
                    print("   spark ", str(a)[:600])
                    print("   duckdb", str(b)[:600])
        except Exception as error:
            failed += 1
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:900]}", flush=True)
    print(f"{failed} of {len(names)} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
