"""Run every registered query at a scale and compare it with its SQL.

    python tools/check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tablewright.session import remove_scratch, session  # noqa: E402
from workload import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return ("decimal", value.normalize())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = session("check", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            got = rows_of(df.columns, df.collect())
        except Exception as error:  # report and go on with the others
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} ({took:.1f}s)", flush=True)
            continue
        cursor = con.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        expected = rows_of(names, cursor.fetchall())
        same = sorted(names) == sorted(df.columns) and got == expected
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(got)} rows ({took:.1f}s)", flush=True)
        if not same:
            bad += 1
            print("  columns", sorted(df.columns), sorted(names))
            there, here = set(expected), set(got)
            extra = [r for r in got if r not in there][:5]
            lost = [r for r in expected if r not in here][:5]
            print("  only in Spark ", extra, "\n  only in oracle", lost, len(expected))
    remove_scratch(spark)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
