"""Job parameters from the session configuration."""

from pyspark.sql import SparkSession

PREFIX = "spark.app."


def job_param(spark: SparkSession, name: str, default: str | None = None) -> str:
    """``spark.app.<name>`` of the session, or ``default``; without either it raises."""
    value = spark.conf.get(PREFIX + name, default)
    if value is None:
        raise KeyError(f"job parameter {PREFIX}{name} is not set")
    return value.strip()
