"""Compare each registered query with its SQL, run by DuckDB on the same files."""

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(value)


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def difference(spark, connection, sf_dir, name, run, sql):
    """None if both sides agree, else a text saying where they do not."""
    result = run(spark, sf_dir)
    rows = result.collect()
    cursor = connection.execute(sql)
    expected_columns = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    if sorted(result.columns) != sorted(expected_columns):
        return f"columns {result.columns} != {expected_columns}"
    got, want = bag(rows, result.columns), bag(expected, expected_columns)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for left, right in zip(got, want):
        if left != right:
            return f"{left} != {right}"
    return None if got else "both sides are empty"


def main(sf_dir, names):
    from pyspark.sql import SparkSession

    from millrace_queries import ORACLE, QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = difference(spark, connection, sf_dir, name, QUERIES[name], ORACLE[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:32} {time.time() - start:6.2f}s  {'ok' if found is None else found}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
