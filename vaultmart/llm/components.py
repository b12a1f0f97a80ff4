"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is one grouped minimum and one join, so no neighbourhood is ever gathered: the minimum
combines before its shuffle, and the join's two sides are plain exchanges that adaptive execution
splits at a hub node.  Distances to the smallest node halve, so the number of rounds grows with the
logarithm of the longest path.  Each round is written to the shared folder; only counts come to
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import write_table


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                        .alias("e")).select("e.a", "e.b")


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours `b` of every `a` to the smallest node m of its neighbourhood: in the large
    star those above `a`, in the small star (pairs hold b < a only) all of them and `a` itself."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("c"), F.least("a", "m").alias("m"))
    # the key as an expression: the minimum's own partitioning is not reused, so that both
    # join inputs are exchanges, which AQE may split at a hub
    key = least.select(F.concat(F.col("c"), F.lit("")).alias("k"), "m")
    joined = pairs.join(key, pairs["a"] == key["k"])
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("c").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def _downward(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b strings): root is the smallest node it reaches."""
    current = write_table(_downward(edges).filter("a <> b").distinct(), "cc")
    while True:
        step = _star(_downward(_star(_both_ways(current), large=True)), large=False)
        following = write_table(step, "cc")
        # sets of edges; when a round changes nothing, every node is linked to its root
        same = (following.count() == current.count()
                and following.join(current, ["a", "b"], "left_anti").limit(1).count() == 0)
        current = following
        if same:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
