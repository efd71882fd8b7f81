"""Time the headline queries and, where there is one, the same work in plain hand-written Spark.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads.  Each query runs once
to warm up and then ``BENCH_RUNS`` times, of which the fastest counts.  Prints one JSON line.
"""

import json
import os
import time

from pyspark.sql import SparkSession, Window, functions as F

from millrace_queries import QUERIES
from millrace_queries.edits import change_messages, edit_messages
from millrace_queries.feed import capture

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def parsed_input(spark, name, frame):
    """Write a derived input once, so that only the query on it is timed."""
    from millrace.workspace import scratch_path

    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def cases(spark):
    """Name to (query, plain Spark or None); both return a frame."""
    from millrace.operators import decode_sse, normalise_recentchange
    from millrace.plans import article_edit_counts, page_edit_counts
    from millrace.schemas import CHANGE, EDIT, RAW_CHANGE
    from millrace.sources import read_sse

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    edits = parsed_input(spark, "edits", edit_messages(spark, SF_DIR))
    changes = parsed_input(spark, "changes", change_messages(spark, SF_DIR))
    feed = capture(spark, SF_DIR)

    def table(name):
        return spark.read.parquet(f"{SF_DIR}/{name}.parquet")

    def plain_report():
        return (
            table("lineitem").groupBy("l_partkey")
            .agg(F.count("l_quantity").alias("cnt"), F.avg("l_quantity").alias("avg"))
            .filter("cnt > 35")
            .join(table("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
            .sort(F.desc("avg"), "l_partkey").limit(10)
        )

    def plain_page_counts():
        return (
            edits.select(F.from_json(F.col("value").cast("string"), EDIT).alias("data"))
            .select("data.page_title", F.try_to_timestamp("data.event_time").alias("event_time"))
            .where("event_time is not null")
            .groupBy(F.window("event_time", "1 minute"), "page_title").count()
        )

    def plain_article_counts():
        return (
            changes.select(F.from_json(F.col("value").cast("string"), CHANGE).alias("data"))
            .select("data.*").withColumn("event_time", F.try_to_timestamp("event_time"))
            .where((F.col("namespace") == 0) & ~F.col("bot") & (F.col("event_type") == "edit"))
            .groupBy(F.window("event_time", "2 minutes"), "page_title")
            .agg(F.count("*"), F.count(F.when(F.col("minor"), 1)), F.count(F.when(~F.col("minor"), 1)))
        )

    def plain_words():
        documents = table("documents")
        return documents.select(F.explode(F.split("text", " ")).alias("word")).groupBy("word").count()

    def plain_rank():
        order = Window.partitionBy("o_orderstatus").orderBy(F.desc("o_totalprice"), "o_orderkey")
        orders = table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
        return orders.withColumn("rank", F.rank().over(order))

    def plain_large_groups():
        order = Window.partitionBy("o_orderstatus").orderBy(F.desc("o_orderdate"))
        orders = table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        return orders.withColumn("rank", F.rank().over(order))

    def plain_feed():
        """Without line ends of other kinds, defaults and keys that are missing."""
        data = F.regexp_extract("value", "(?s)data: (.*)", 1)
        return spark.read.text(feed, lineSep="\n\n").select(
            F.from_json(F.replace(data, F.lit("\ndata: "), F.lit("\n")), RAW_CHANGE).alias("c")) \
            .select("c.*")

    registered = {
        name: lambda name=name: QUERIES[name](spark, SF_DIR)
        for name in (
            "ratings_report", "ratings_ranking", "global_average", "count_by",
            "ratings_report_from_files", "read_delimited_multichar", "read_csv_inferred",
            "write_parquet", "lift_nested_field", "rank_within", "rank_within_large_groups",
            "rank_within_whole_table",
            "word_counts", "windowed_edit_counts", "stream_page_counts", "stream_words",
        )
    }
    plain = {
        "ratings_report": plain_report, "rank_within": plain_rank, "word_counts": plain_words,
        "rank_within_large_groups": plain_large_groups,
    }
    result = {name: (run, plain.get(name)) for name, run in registered.items()}
    result["page_edit_counts"] = (lambda: page_edit_counts(edits), plain_page_counts)
    result["article_edit_counts"] = (lambda: article_edit_counts(changes), plain_article_counts)
    result["feed_changes"] = (
        lambda: normalise_recentchange(decode_sse(read_sse(spark, feed))), plain_feed
    )
    return result


def timed(run):
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def fastest(*candidates):
    """Fastest time of each; they take turns, so that none profits from a warmer JVM."""
    rounds = [[timed(run) for run in candidates] for _ in range(RUNS + 1)]
    return [round(min(times), 3) for times in zip(*rounds[1:])]


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, plain = {}, {}
    for name, (run, baseline) in cases(spark).items():
        if baseline is None:
            (seconds[name],) = fastest(run)
        else:
            seconds[name], plain[name] = fastest(run, baseline)
    spark.stop()
    print(json.dumps({
        "metric": "sum of fastest query times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "plain_spark": plain,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
