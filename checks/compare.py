"""Compare queries with their SQL, as a command: python -m checks.compare [sf_dir] [name ...]."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> str:
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns and rows agree."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    expected = _rows(names, want.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    got = _rows(df.columns, df.collect())
    if got == expected:
        return []
    extra, lacking = set(got) - set(expected), set(expected) - set(got)
    return [
        f"{len(got)} rows instead of {len(expected)}",
        f"only here: {sorted(extra)[:3]}",
        f"only there: {sorted(lacking)[:3]}",
    ]


def session(cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("floorwatch-checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main(arguments: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(QUERIES)
    spark, con, bad = session(), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                found = differences(df, con, ORACLE[name])
            else:
                found = [] if df.count() >= 0 else ["no rows"]
                name += " (rows only)"
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print("ok  " if not found else "FAIL", f"{time.time() - start:5.1f}s", name, *found, sep="  ", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
