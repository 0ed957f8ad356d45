"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum, written, and a join of two plain tables, which
Spark splits where a hub has many neighbours; so neither a component nor the
neighbours of a hub are gathered in one task.  The number of rounds grows with
the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    least = stash(least, "cc_least")
    return (both.join(least, both["a"] == least["k"]).filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
    least = stash(least, "cc_least")
    linked = down.join(least, down["a"] == least["k"]).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionAll(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, root): every node of an edge with the smallest node of its component."""
    e = stash(edges.filter("a <> b").select("a", "b").distinct(), "cc")
    before = None
    while True:
        n, mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not n or (n, mark) == before:
            break
        before = (n, mark)
        e = stash(_small_star(_large_star(e)), "cc")
    leaves = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionAll(leaves.select(F.col("root").alias("node"), "root").distinct())
