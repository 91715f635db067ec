"""Compare every query with its SQL oracle: python tests/oracle_check.py [folder] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tagloom.session import build_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(spark, con, folder: str, name: str) -> str | None:
    """What is different, or None."""
    df = entry.queries()[name](spark, folder)
    found = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    expected = Counter(found.fetchall())
    actual = Counter(tuple(row) for row in df.select(*columns).collect())
    if actual == expected:
        return None
    return (f"{actual.total()} rows != {expected.total()}; extra {list((actual - expected).items())[:3]}"
            f"; missing {list((expected - actual).items())[:3]}")


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                         "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in sys.argv[2:] or entry.queries():
        begin = time.time()
        try:
            problem = differences(spark, con, folder, name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - begin:6.2f}s  {problem or 'ok'}", flush=True)
    sys.exit(bool(failed))
