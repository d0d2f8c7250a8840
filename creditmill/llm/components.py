"""Connected components in DataFrame operations, by alternating large and small stars.

Edges point from the larger node to the smaller. A star step hangs every neighbour of a node on the smallest node around;
a few rounds leave stars whose centre is the smallest node of the component. Only sums reach the driver. A node with very
many edges is worked on in parts.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditmill.llm.common import with_least
from creditmill.session import settle


FEW_EDGES = 100_000  # 16 bytes each; so few edges are kept in one partition, where a round is one task without a shuffle
BROADCAST_EDGES = 1_000_000  # 16 bytes each; up to so many edges the smallest neighbours are broadcast


def _least_around(rows: DataFrame, n_edges: int) -> DataFrame:
    """Rows (u, v) with m, the smallest v of their u."""
    if n_edges <= FEW_EDGES:
        return rows.withColumn("m", F.min("v").over(W.partitionBy("u")))
    if n_edges > BROADCAST_EDGES:
        return with_least(rows, ["u"], "v", m=F.col("v"))
    return rows.join(F.broadcast(rows.groupBy("u").agg(F.min("v").alias("m"))), "u")


def _also(rows: DataFrame, u: str, v: str) -> DataFrame:
    """Rows (u, v), and beside each a second one from two of its columns; partitions stay as they are."""
    return rows.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col(u).alias("u"), F.col(v).alias("v")))))


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another; the component is its smallest node."""
    state = settle(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    seen = _checksum(state)
    while seen[0]:
        few = seen[0] <= FEW_EDGES
        if few:
            state = state.coalesce(1)
        both = _also(state, "v", "u") if few else state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_least_around(both, seen[0]).filter("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        small = _least_around(large, seen[0])
        if few:
            hung = _also(small.select("u", F.col("v").alias("w"), F.col("m").alias("v")), "w", "v").filter("u <> v").distinct()
        else:
            hung = (small.select("u", F.col("m").alias("v"))
                    .union(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        state = settle(hung)
        now = _checksum(state)
        if now == seen:
            break
        seen = now
    if seen[0] <= FEW_EDGES:
        return _also(state.coalesce(1), "v", "v").select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
    centres = state.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(centres)
