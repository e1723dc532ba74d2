"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.plans.scratch import written


def components(edges: DataFrame, under: str | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: longs, any direction); a component is its smallest node.

    Alternates two steps that turn each node's neighbourhood into a star around its smallest member. A step is an
    aggregate and a join on the node, so that a node with very many neighbours is pre-aggregated, and its rows can be
    split by Spark. The number of rounds grows with the logarithm of the longest path. Each round is a table written
    ``under`` a scratch folder.
    """
    now = written(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "components", under)
    before = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if mark == before:
            return now.selectExpr("u AS node", "v AS component").unionByName(
                now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node")))
        before = mark
        both = now.unionByName(now.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = written(both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").distinct(), "components", under)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v").unionByName(least.selectExpr("u", "m AS v"))
        now = written(small.distinct(), "components", under)
