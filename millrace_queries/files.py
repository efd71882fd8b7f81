"""Sources and sinks: a table is written out in some format and read back whole."""

from pyspark.sql import functions as F

from millrace.operators import global_average
from millrace.plans import jobs, ratings_report
from millrace.schemas import DATED_MOVIES, MOVIES, RATINGS
from millrace.sinks import write_csv, write_parquet
from millrace.sources import read_csv_inferred, read_delimited
from millrace.workspace import scratch_path

from .ratings import MIN_COUNT, RATED, rounded
from .registry import query, table


def delimited(spark, df, delimiter, *columns):
    """Write columns as plain delimited lines; returns the path."""
    path = scratch_path(spark, "delimited")
    df.select(F.concat_ws(delimiter, *columns)).write.text(path)
    return path


def rating_lines(spark, sf_dir, delimiter):
    return delimited(
        spark, table(spark, sf_dir, "lineitem"), delimiter, "l_orderkey", "l_partkey",
        "l_quantity", F.unix_timestamp("l_shipdate"),
    )


@query("read_delimited_multichar", """
    SELECT CAST(l_orderkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS item_id,
           l_quantity AS rating, CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp"
    FROM lineitem
""")
def read_delimited_multichar(spark, sf_dir):
    return read_delimited(spark, rating_lines(spark, sf_dir, "::"), RATINGS, "::")


@query("average_from_delimited",
       'SELECT round(avg(l_quantity), 6) AS "avg(rating)" FROM lineitem')
def average_from_delimited(spark, sf_dir):
    ratings = read_delimited(spark, rating_lines(spark, sf_dir, "::"), RATINGS, "::")
    return rounded(global_average(ratings, "rating"), "avg(rating)")


@query("read_delimited_prefix",
       "SELECT CAST(p_partkey AS INTEGER) AS movie_id, p_name AS movie_title FROM part")
def read_delimited_prefix(spark, sf_dir):
    """Six columns in the file, two in the schema."""
    part = table(spark, sf_dir, "part")
    return read_delimited(spark, delimited(spark, part, "|", *part.columns), MOVIES, "|")


@query("ratings_report_from_files", f"""
    SELECT CAST(l_partkey AS INTEGER) AS item_id, cnt, avg,
           CAST(p_partkey AS INTEGER) AS movie_id, p_name AS movie_title
    FROM ({RATED}) JOIN part ON l_partkey = p_partkey
    ORDER BY avg DESC, item_id LIMIT 10
""")
def ratings_report_from_files(spark, sf_dir):
    """Tab-separated ratings and pipe-separated titles to the top ten."""
    part = table(spark, sf_dir, "part")
    ratings = read_delimited(spark, rating_lines(spark, sf_dir, "\t"), RATINGS, "\t")
    titles = read_delimited(spark, delimited(spark, part, "|", *part.columns), MOVIES, "|")
    return rounded(ratings_report(ratings, titles, 10, MIN_COUNT))


@query("read_delimited_dates", """
    SELECT CAST(o_orderkey AS INTEGER) AS movie_id, o_orderpriority AS movie_title,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
           AS date
    FROM orders
""")
def read_delimited_dates(spark, sf_dir):
    """Dates such as 3-Oct-1998; pending orders have one in another pattern, which reads as NULL."""
    pattern = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "d-MMM-yyyy"))
    orders = table(spark, sf_dir, "orders")
    path = delimited(spark, orders, "|", "o_orderkey", "o_orderpriority",
                     F.coalesce(pattern, F.date_format("o_orderdate", "yyyy-MM-dd")))
    dated = read_delimited(spark, path, DATED_MOVIES, "|", date_format="d-MMM-yyyy")
    return dated.withColumn("date", F.col("date").cast("string"))


@query("read_csv_inferred", "SELECT * FROM part")
def read_csv_with_inferred_types(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "part"), path)
    return read_csv_inferred(spark, path).withColumn("p_partkey", F.col("p_partkey").cast("long"))


@query("write_csv", "SELECT * FROM orders")
def write_csv_in_files(spark, sf_dir):
    """Four files with the orders sorted by price across them."""
    path, orders = scratch_path(spark, "csv"), table(spark, sf_dir, "orders")
    write_csv(orders, path, num_files=4, sort_by=["o_totalprice", "o_orderkey"])
    return read_delimited(spark, path, orders.schema, header=True)


@query("write_csv_one_file", "SELECT * FROM orders")
def write_csv_in_one_file(spark, sf_dir):
    """Unsorted, in the one file that is the default."""
    path, orders = scratch_path(spark, "csv"), table(spark, sf_dir, "orders")
    write_csv(orders, path, num_files=1)
    return read_delimited(spark, path, orders.schema, header=True)


@query("write_parquet", "SELECT * FROM lineitem")
def write_parquet_plain(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "lineitem"), path)
    return spark.read.parquet(path)


@query("write_parquet_partitioned", """
    SELECT event_id, user_id,
           CASE WHEN event_type <> 'error' THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS date
    FROM events
""")
def write_parquet_by_date(spark, sf_dir):
    """One directory per day, and one for the errors, which have no date."""
    path = scratch_path(spark, "parquet")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.to_date("ts")).alias("date"),
    )
    write_parquet(events, path, partition_by=["date"])
    written = spark.read.schema(events.schema).parquet(path)
    return written.withColumn("date", F.col("date").cast("string"))


@query("ratings_job", f"""
    SELECT CAST(l_partkey AS INTEGER) AS item_id, cnt, avg, CAST(l_partkey AS INTEGER) AS movie_id,
           p_name AS movie_title
    FROM ({RATED}) JOIN part ON p_partkey = l_partkey
""")
def ratings_job(spark, sf_dir):
    """The report job with all its settings from the session; every item above the threshold."""
    settings = {
        "ratings_path": rating_lines(spark, sf_dir, "\t"),
        "movies_path": delimited(spark, table(spark, sf_dir, "part"), "|", "p_partkey", "p_name"),
        "output_path": scratch_path(spark, "report"), "min_count": str(MIN_COUNT),
    }
    for name, value in settings.items():
        spark.conf.set(f"spark.app.{name}", value)
    try:
        jobs.ratings_report(spark)
    finally:
        for name in settings:
            spark.conf.unset(f"spark.app.{name}")
    return rounded(spark.read.parquet(settings["output_path"]))
