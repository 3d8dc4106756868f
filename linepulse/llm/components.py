"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import stage


def _star(edges: DataFrame, centres: DataFrame) -> DataFrame:
    """Hang every neighbour ``v`` of ``u`` under the smallest of u's neighbourhood."""
    least = centres.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least.select("u", F.least("u", "m").alias("m")), "u")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, root): for each node of ``links`` (u long, v long) that is not the
    smallest of its connected component, that smallest node.

    Large-star and small-star steps alternate until the links stay the same;
    each only takes minima by key and joins them back, so a hot node is
    pre-aggregated before the shuffle and split in the join.  Every round is a
    written table, and no link reaches the driver.  Null nodes and self links
    are left out; no links give an empty result.
    """
    edges = stage(links.filter(F.col("u") != F.col("v"))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_star(both, both).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = _star(large, large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v")))
                 .filter(F.col("u") != F.col("v")).distinct())
        edges = stage(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
                        F.count_distinct("u")).first()
        if now == before or now[0] == 0:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.groupBy("u").agg(F.min("v").alias("root"))
