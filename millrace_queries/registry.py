"""Registry of queries and the helpers they share."""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str):
    """Register ``fn(spark, sf_dir)`` under ``name``, with ``sql`` as its check.

    Times are compared as UTC, so the session has that zone while the query is made; the zone is
    part of the plan from then on.
    """
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            before = spark.conf.get("spark.sql.session.timeZone")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            try:
                return fn(spark, sf_dir)
            finally:
                spark.conf.set("spark.sql.session.timeZone", before)

        QUERIES[name], ORACLE[name] = run, sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_zone(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as wall-clock time of the session zone, which is what the SQL side has."""
    return df.withColumns({c: df[c].cast("timestamp_ntz") for c in columns})
