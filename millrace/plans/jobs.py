"""Jobs to submit: each takes its paths and settings from ``spark.app.*`` of the session.

``spark-submit --properties-file conf/example.properties run_job.py ratings_report``
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import global_average, lift_nested_field
from ..schemas import DATED_MOVIES, MOVIES, RATINGS
from ..sinks import write_parquet
from ..sources import (
    job_param, read_delimited, read_json, read_sse, read_stream_output,
)
from ..streaming import (
    kafka_sink, kafka_source, line_source, stream_sse, stream_to_console, stream_to_parquet,
)
from .edits import article_edit_counts, page_edit_counts
from .feed import change_messages
from .reports import ratings_report as report

Result = DataFrame | StreamingQuery | None


def average_rating(spark: SparkSession) -> Result:
    """``::``-separated ratings to Parquet, and their average, taken from the Parquet files so that
    the text is parsed once."""
    path = job_param(spark, "output_path")
    ratings = read_delimited(spark, job_param(spark, "ratings_path"), RATINGS, "::")
    write_parquet(ratings, path)
    return global_average(spark.read.parquet(path), "rating")


def ratings_report(spark: SparkSession) -> Result:
    """Tab-separated ratings and pipe-separated titles to all titles rated often enough, best first,
    or the ``top`` of them."""
    return _written(spark, report(
        read_delimited(spark, job_param(spark, "ratings_path"), RATINGS, "\t"),
        read_delimited(spark, job_param(spark, "movies_path"), MOVIES, "|"),
        k=_top(spark), min_count=int(job_param(spark, "min_count", "100")),
    ), "output_path")


def movies_by_date(spark: SparkSession) -> Result:
    """Pipe-separated titles with a date to Parquet, one directory per date."""
    movies = read_delimited(spark, job_param(spark, "movies_path"), DATED_MOVIES, "|",
                            date_format="d-MMM-yyyy")
    write_parquet(movies, job_param(spark, "output_path"), partition_by=["date"])
    return movies


def nested_field(spark: SparkSession) -> Result:
    """JSON lines that have a nested field, with that field as a column."""
    documents = read_json(spark, job_param(spark, "json_path"))
    lifted = lift_nested_field(documents, job_param(spark, "field", "attributes.AgesAllowed"))
    return _written(spark, lifted, "output_path")


def echo_lines(spark: SparkSession) -> Result:
    """Lines of a socket to the console, as they come."""
    lines = line_source(spark, job_param(spark, "host", "localhost"),
                        int(job_param(spark, "port", "9999")))
    return stream_to_console(lines.select("value"), {"continuous": "1 second"})


def page_counts(spark: SparkSession) -> Result:
    """Simulated edits of a topic to counts per minute and page."""
    return stream_to_parquet(
        page_edit_counts(_messages(spark)), job_param(spark, "output_path"),
        job_param(spark, "checkpoint_dir"),
    )


def article_counts(spark: SparkSession) -> Result:
    """Change events of a topic to counts per two minutes and page, a directory per window."""
    files = job_param(spark, "files_per_batch", "")
    return stream_to_parquet(
        article_edit_counts(_messages(spark)), job_param(spark, "output_path"),
        job_param(spark, "checkpoint_dir"), partition_by=["window_start"],
        trigger={"processingTime": "1 minute"}, files_per_batch=int(files) if files else None,
    )


def latest_counts(spark: SparkSession) -> Result:
    """What a counting job has written, latest window and largest count first, all of it or the
    ``top`` of it; to ``report_path`` if that is set."""
    order = job_param(spark, "order_by", "window_start,edit_count").split(",")
    return _written(spark, read_stream_output(
        spark, job_param(spark, "output_path"), order, _top(spark)), "report_path")


def feed_messages(spark: SparkSession) -> Result:
    """Captured change feed to a topic; goes on as files are added if there is a checkpoint."""
    path = job_param(spark, "feed_path")
    servers, topic = job_param(spark, "kafka_bootstrap_servers"), job_param(spark, "kafka_topic")
    checkpoint = job_param(spark, "checkpoint_dir", "")

    def send(events: DataFrame, epoch_id: int = 0) -> None:
        kafka_sink(change_messages(events), servers, topic)

    if checkpoint:
        return stream_sse(spark, path, send, checkpoint)
    return send(read_sse(spark, path))


def _top(spark: SparkSession) -> int | None:
    """How many rows are asked for; all unless ``top`` is set."""
    top = job_param(spark, "top", "")
    return int(top) if top else None


def _written(spark: SparkSession, result: DataFrame, setting: str) -> DataFrame:
    """``result``, written to Parquet first if ``setting`` names a path."""
    path = job_param(spark, setting, "")
    if not path:
        return result
    write_parquet(result, path)
    return spark.read.parquet(path)


def _messages(spark: SparkSession) -> DataFrame:
    return kafka_source(
        spark, job_param(spark, "kafka_bootstrap_servers"), job_param(spark, "kafka_topic"),
        job_param(spark, "starting_offsets", "latest"),
    )


JOBS = {
    job.__name__: job
    for job in (
        average_rating, ratings_report, movies_by_date, nested_field, echo_lines,
        page_counts, article_counts, latest_counts, feed_messages,
    )
}


def run(spark: SparkSession, name: str) -> None:
    """Run a job: show the first rows of its result, or wait for its stream and stop it at the end."""
    result = JOBS[name](spark)
    if isinstance(result, DataFrame):
        result.printSchema()
        result.show(20, truncate=False)
    elif result is not None:
        try:
            result.awaitTermination()
        except KeyboardInterrupt:
            result.stop()
