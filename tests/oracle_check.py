"""Run queries beside their SQL: same rows, names and value kinds.

    python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _kind(arrow_type) -> str:
    import pyarrow.types as pt

    for kind, test in (("bool", pt.is_boolean), ("int", pt.is_integer), ("float", pt.is_floating),
                       ("text", lambda x: pt.is_string(x) or pt.is_large_string(x))):
        if test(arrow_type):
            return kind
    return str(arrow_type)


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(((tuple(_value(v) for v in row)) for row in zip(*columns)), key=repr)


def compare(spark_table, sql_table) -> str | None:
    """None when alike, else what differs."""
    if sorted(spark_table.column_names) != sorted(sql_table.column_names):
        return f"columns {spark_table.column_names} / {sql_table.column_names}"
    for n in spark_table.column_names:
        a, b = spark_table.schema.field(n).type, sql_table.schema.field(n).type
        if str(a) != str(b) and _kind(a) != _kind(b):
            return f"type of {n}: {a} / {b}"
    a, b = _rows(spark_table), _rows(sql_table)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, such as {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            result = queries[name](spark, folder).toArrow()
            problem = compare(result, db.sql(oracles[name]).to_arrow_table()) if name in oracles else None
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        state = "FAIL" if problem else ("ok" if name in oracles else "rows only")
        failed += bool(problem)
        print(f"{state:9} {name:22} {time.time() - start:6.2f}s {problem or result.num_rows}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
