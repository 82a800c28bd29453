"""Run registered queries in Spark and their check texts in DuckDB and compare the rows.

    python -m tests.compare SF_DIR [key prefix ...]
"""

from __future__ import annotations

import datetime
import sys
import time

import duckdb

from lapgraph.plans.fixtures import BASE_TABLES


def normal(value):
    if isinstance(value, float):
        return ("float", 0.0 if value == 0 else round(value, 6))
    if isinstance(value, (list, tuple)):
        return ("list", tuple(normal(v) for v in value))
    if isinstance(value, datetime.datetime):
        return ("ts", value.replace(tzinfo=None))
    return (type(value).__name__, value)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normalized = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(normalized, key=repr)


def compare(spark, con, sf_dir: str, key: str, builder, sql: str | None):
    """(status, row count, detail) of one query."""
    df = builder(spark, sf_dir)
    columns, rows = rows_of(df.columns, df.collect())
    if sql is None:
        return "rows-only", len(rows), ""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_columns, expected = rows_of(names, result.fetchall())
    if columns != expected_columns:
        return "COLUMNS", len(rows), f"{columns} != {expected_columns}"
    if len(rows) != len(expected):
        return "COUNT", len(rows), f"{len(rows)} != {len(expected)}"
    for got, want in zip(rows, expected):
        if got != want:
            return "VALUES", len(rows), f"\n   spark {got}\n   check {want}"
    return "ok", len(rows), ""


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from lapgraph.session import get_spark

    sf_dir, prefixes = sys.argv[1], sys.argv[2:]
    spark = get_spark(
        "compare",
        extra_conf={"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                    "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
        log_level="ERROR",
    )
    con = duck(sf_dir)
    checks = entry.oracle_sql()
    bad = 0
    for key, builder in entry.queries().items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        began = time.time()
        try:
            status, count, detail = compare(spark, con, sf_dir, key, builder, checks.get(key))
        except Exception as error:  # report and go on with the next query
            status, count, detail = "ERROR", 0, str(error)[:1500]
        bad += status not in ("ok", "rows-only")
        print(f"{status:9} {key:36} {count:7} {time.time() - began:6.1f}s {detail}", flush=True)
    print("not equal:", bad)


if __name__ == "__main__":
    main()
