"""Runs registered queries next to their SQL: python tests/compare.py [sf] [name part …]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    """An in-process DuckDB with the tables as views."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def _sortable(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def differences(df, con, sql) -> list[str]:
    """What differs between a Spark result and the SQL's result; empty if nothing does."""
    result = con.sql(sql)
    expected_types = dict(zip(result.columns, map(str, result.types)))
    actual_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if expected_types != actual_types:
        return [f"schema: spark {actual_types} sql {expected_types}"]
    names = sorted(actual_types)
    actual = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_sortable)
    order = [result.columns.index(n) for n in names]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_sortable)
    if len(actual) != len(expected):
        return [f"rows: spark {len(actual)} sql {len(expected)}"]
    bad = []
    for a, e in zip(actual, expected):
        same = all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, e)
        )
        if not same:
            bad.append(f"{str(a)[:400]}\n      <> {str(e)[:400]}")
    return [f"{len(bad)} rows differ, such as {names} {bad[0]}"] if bad else []


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = oracle_connection(folder), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in oracles:
                found = differences(df, con, oracles[name])
                note = f"{con.sql(oracles[name]).shape[0]} rows" if not found else "\n    ".join(found)
            else:
                found, note = [], f"rows only: {len(df.collect())} rows"
        except Exception as error:  # report and go on with the next query
            found, note = ["error"], f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
