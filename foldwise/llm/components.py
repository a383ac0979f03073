"""Connected components of a distributed edge list (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import staged


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m the least of u and its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return pairs.join(least, pairs["u"] == least["c"]).select("u", "v", "m")


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the least node of its component.

    Each round is two joins on the edge list, which never grows; the list is staged, so rounds do not pile up lineage.  They end
    when the edges are stars: each node has one neighbour, which has none itself."""
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        if not now.groupBy("u").count().filter("count > 1").limit(1).count() and \
                not now.join(now.select(F.col("v").alias("c")), F.col("u") == F.col("c"), "left_semi").limit(1).count():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        s = _star(large)
        small = s.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(s.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = staged(small)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
