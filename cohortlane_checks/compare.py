"""Compare registered queries with their SQL: names, types, row counts and values.

    python -m cohortlane_checks.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from .oracle import ORACLE
from .queries import registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# DuckDB type -> Spark type.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value: object) -> str:
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, Decimal):
        return f"decimal:{value}"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return repr(value)


def rows(columns: list[str], data: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {n: t for n, t in dict(df.dtypes).items() if kinds[n] != t}
    if types:
        return f"types {types} != { {n: kinds[n] for n in types} }"
    got = rows(df.columns, df.collect())
    want = rows(names, expected)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return f"first difference {g} != {w}"
    return None if got else "no rows"


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name, run in registered().items():
        if argv[1:] and name not in argv[1:]:
            continue
        began = time.time()
        try:
            problem = difference(run(spark, folder), con, ORACLE[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
