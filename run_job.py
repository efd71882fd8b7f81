"""``spark-submit [--properties-file ..] run_job.py <job>``; see ``millrace/plans/jobs.py``."""

import argparse
import logging

from pyspark.sql import SparkSession

from millrace.plans.jobs import JOBS, run


def main() -> None:
    parser = argparse.ArgumentParser(description="Run one job.")
    parser.add_argument("job", choices=sorted(JOBS))
    job = parser.parse_args().job
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName(job).getOrCreate()
    try:
        run(spark, job)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
