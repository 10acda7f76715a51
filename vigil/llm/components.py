"""Connected components of an edge table, by joins and grouping alone.

Alternating large-star and small-star steps: every round is a partial
aggregate (the smallest neighbour) and a salted join, its result a table in the
shared folder. Nothing is collected; the number of rounds grows with the
logarithm of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import salted_join, written


def _star(directed: DataFrame) -> DataFrame:
    """For each ``u``: its smallest neighbour ``m`` (or itself) next to every neighbour ``v``."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return salted_join(directed, least, "u", "inner")


def _sum(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v, both long, not
    null); a component's id is its smallest node."""
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "edges")
    before = None
    while True:
        state = _sum(now)
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = written(large.distinct(), "large-star")
        # Every u of ``large`` is larger than its v: the neighbours of a small star.
        small = _star(large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))))
        now = written(small.filter("u <> v").distinct(), "small-star")
    return (now.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
