"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import delete, stash_at


#: Parts of the edges of a node.
SPREAD = 8


def _spread(edges: DataFrame, least: DataFrame, node: str, other: str) -> DataFrame:
    """edges joined with the minima of their nodes, which have 16 bytes each."""
    part = F.pmod(F.xxhash64(other), F.lit(SPREAD)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    return edges.withColumn("part", part).join(least.withColumn("part", every).hint("merge"), [node, "part"]).drop("part")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of an edge but the roots; root is the smallest node reachable.

    Each round is written to the shared folder, and the round before is deleted. No list of neighbours is ever
    gathered: minima are aggregated before they move, and where they come back the edges of each node are dealt to
    SPREAD tasks, for each of which the node's minimum is repeated. Edges with a null end and loops are ignored."""
    spark = edges.sparkSession
    e, path = stash_at(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo"))).distinct(),
        "edges",
    )
    state = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        state = now
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _spread(both.where("v > u"), least, "u", "v").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = _spread(large, least, "hi", "lo").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        old = path
        e, path = stash_at(small.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        delete(spark, old)
