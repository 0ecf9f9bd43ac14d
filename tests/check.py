"""Compare registered queries with their SQL: python -m tests.check [sf_dir] [key ...]"""

from __future__ import annotations

import sys
import time

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet')")
    return con


# Spark type, DuckDB type of the same column.
SAME_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def compare(frame, con, sql):
    """None if both give the same columns, types and rows in any order, else what differs."""
    relation = con.sql(sql)
    ours = {f.name: SAME_TYPES[f.dataType.simpleString()] for f in frame.schema.fields}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"columns: {ours} != {theirs}"
    names = sorted(ours)
    left = sorted((tuple(r) for r in frame.select(names).collect()), key=repr)
    quoted = ", ".join('"' + name + '"' for name in names)
    right = sorted(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=repr)
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    for key in keys:
        start = time.time()
        problem = compare(entry.queries()[key](spark, sf_dir), con, oracles[key])
        print(f"{time.time() - start:8.2f} {key}: {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
