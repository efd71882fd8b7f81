"""Connected components of a link table, and joins whose left side has hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.workspace import stored

#: A key's rows on the large side of a join are dealt over so many tasks.
SALTS = 32


def join_salted(left: DataFrame, right: DataFrame, keys: list[str], salt: Column,
                how: str = "inner") -> DataFrame:
    """Join where few keys may have very many rows on the left; keys are unique on the right.

    The right side is repeated once for each salt, so it should be the small one.
    """
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                              F.lit(SALTS - 1).cast("bigint"))))
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for nodes that are not it.

    Each round hangs all parents of a node under the smallest of them, and then each node under its
    parent's parent; a round halves the length of every way at least.  Tables are written between
    rounds.  A node that very many others hang under is hot as a parent only, and the join that
    looks up parents is salted.
    """
    edges = stored(
        links.select(F.greatest(one, other).alias("child"), F.least(one, other).alias("parent"))
        .where("child <> parent").distinct(), "links")
    siblings = Window.partitionBy("child")
    while True:
        hung = stored(
            edges.withColumn("low", F.min("parent").over(siblings)).select(
                F.when(F.col("parent") == F.col("low"), F.col("child"))
                .otherwise(F.col("parent")).alias("child"), F.col("low").alias("parent"))
            .distinct(), "links")
        above = hung.groupBy("child").agg(F.min("parent").alias("up"), F.count("*").alias("n"))
        middle = stored(hung.select(F.col("parent").alias("child")).distinct()
                        .join(above, "child").select(F.col("child").alias("parent"), "up"), "links")
        if middle.isEmpty() and above.where("n > 1").isEmpty():
            return hung.select(F.col("child").alias("node"), F.col("parent").alias("component"))
        edges = join_salted(hung, middle, ["parent"], F.col("child"), "left").select(
            "child", F.coalesce("up", "parent").alias("parent")).distinct()
