"""Rank within groups; the order status has three values, each with a third of the orders."""

from millrace.operators import rank_within

from .registry import query, table


def orders(spark, sf_dir, *columns):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", *columns)


@query("rank_within", """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rank
    FROM orders
""")
def rank_by_price(spark, sf_dir):
    return rank_within(orders(spark, sf_dir, "o_totalprice"), ["o_orderstatus"],
                       ["o_totalprice", "o_orderkey"], [False, True])


@query("rank_within_large_groups", """
    SELECT o_orderkey, o_orderstatus, o_orderdate,
           rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC) AS rank
    FROM orders
""")
def rank_large_groups(spark, sf_dir):
    """Large groups with ties."""
    return rank_within(orders(spark, sf_dir, "o_orderdate"), ["o_orderstatus"], ["o_orderdate"],
                       [False])


@query("rank_within_large_ties", """
    SELECT o_orderkey, o_orderstatus, o_orderpriority,
           rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority) AS rank
    FROM orders
""")
def rank_large_ties(spark, sf_dir):
    """Large groups in which each order value is shared by very many rows."""
    return rank_within(orders(spark, sf_dir, "o_orderpriority"), ["o_orderstatus"],
                       ["o_orderpriority"])


@query("rank_within_small_groups", """
    SELECT o_orderkey, o_custkey, o_totalprice,
           rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS price_rank
    FROM orders
""")
def rank_small_groups(spark, sf_dir):
    return rank_within(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        ["o_custkey"], ["o_totalprice"], name="price_rank",
    )


@query("rank_within_whole_table", """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           rank() OVER (ORDER BY o_totalprice DESC) AS rank
    FROM orders
""")
def rank_whole_table(spark, sf_dir):
    return rank_within(orders(spark, sf_dir, "o_totalprice"), [], ["o_totalprice"], [False])


@query("rank_within_odd_names", """
    SELECT o_orderkey AS _rank, o_orderstatus AS k, o_orderpriority AS _k,
           rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority) AS rank
    FROM orders
""")
def rank_odd_names(spark, sf_dir):
    """Columns whose names look like helpers' names."""
    odd = orders(spark, sf_dir, "o_orderpriority").toDF("_rank", "k", "_k")
    return rank_within(odd, ["k"], ["_k"])
