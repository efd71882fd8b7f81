"""Rating reports: ``lineitem`` quantities stand in for ratings, ``part`` for the titles."""

from pyspark.sql import functions as F

from millrace.operators import count_by, enrich_with_title, global_average, rated_items, top_rated
from millrace.plans import ratings_report as report

from .registry import query, table

# A part has about 30 line items at every scale, so this keeps the most rated few per cent.
MIN_COUNT = 35

RATED = f"""
    SELECT l_partkey, count(l_quantity) AS cnt, round(avg(l_quantity), 6) AS avg
    FROM lineitem GROUP BY l_partkey HAVING count(l_quantity) > {MIN_COUNT}
"""


def rounded(df, column="avg"):
    """Sums of doubles depend on their order in the last digits."""
    return df.withColumn(column, F.round(column, 6))


def titles(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name")


@query("ratings_report", f"""
    SELECT l_partkey, cnt, avg, p_partkey, p_name
    FROM ({RATED}) JOIN part ON l_partkey = p_partkey
    ORDER BY avg DESC, l_partkey LIMIT 10
""")
def ratings_report(spark, sf_dir):
    top = report(table(spark, sf_dir, "lineitem"), titles(spark, sf_dir), k=10,
                 min_count=MIN_COUNT, item="l_partkey", rating="l_quantity",
                 title_key="p_partkey")
    return rounded(top)


@query("ratings_ranking", f"SELECT l_partkey, cnt, avg, p_partkey, p_name FROM ({RATED}) "
       "JOIN part ON l_partkey = p_partkey")
def ratings_ranking(spark, sf_dir):
    """The whole report, sorted, without a limit."""
    ranking = report(table(spark, sf_dir, "lineitem"), titles(spark, sf_dir),
                     min_count=MIN_COUNT, item="l_partkey", rating="l_quantity",
                     title_key="p_partkey")
    return rounded(ranking)


@query("rated_items", RATED)
def rated_items_above(spark, sf_dir):
    items = rated_items(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity", MIN_COUNT)
    return rounded(items)


@query("enrich_with_title", """
    SELECT l_partkey, cnt, avg, p_partkey, p_name
    FROM (SELECT l_partkey, count(l_quantity) AS cnt, round(avg(l_quantity), 6) AS avg
          FROM lineitem GROUP BY l_partkey)
    JOIN part ON l_partkey = p_partkey
""")
def enriched_items(spark, sf_dir):
    """Every part that was ordered with its name."""
    items = rated_items(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity", 0)
    return rounded(enrich_with_title(items, titles(spark, sf_dir), "l_partkey", "p_partkey"))


@query("top_rated",
       "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_rated(orders, 20, by="o_totalprice", tie="o_orderkey")


@query("global_average", "SELECT round(avg(l_quantity), 6) AS avg_quantity FROM lineitem")
def average_quantity(spark, sf_dir):
    average = global_average(table(spark, sf_dir, "lineitem"), "l_quantity", "avg_quantity")
    return rounded(average, "avg_quantity")


@query("count_by",
       'SELECT l_partkey, count(*) AS "count" FROM lineitem GROUP BY l_partkey')
def count_by_part(spark, sf_dir):
    return count_by(table(spark, sf_dir, "lineitem"), "l_partkey")


@query("count_by_few_keys",
       'SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL')
def count_by_flags(spark, sf_dir):
    """Few keys that each hold much of the table."""
    return count_by(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", name="n")
