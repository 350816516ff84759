"""Connected components by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014. Edges are kept as
``(u, v)`` with ``u > v``. The smallest id of a component ends up as the label of all its nodes.

Before the first round each partition's edges are replaced by a spanning forest of them, where they are: every node
is linked to the smallest node of its component within the partition. Components are unchanged, a partition keeps
at most one edge per node, and a dense family (a clique of near-copies) enters the rounds as a star.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from namefold.functions.kernels import spanning_forest
from namefold.workspace import Workspace


# Large star: the larger neighbours of a node are linked to the smallest node around it. Small star: the
# smaller neighbours of a node, and the node itself, are linked to the smallest of them. Both map every
# edge to one edge. The smallest neighbours are aggregated before the exchange and written, so a join has
# a plain table on either side and Spark can split the edges of a hub or of the label of a giant component.
_LOWEST = "select u, min(v) as low from {edges} group by u"
_LARGE = "select e.u, coalesce(l.low, e.v) as v, l.low is not null as moved from {edges} e left join {low} l on e.v = l.u"
_SMALL = """
select case when e.v = s.low then e.u else e.v end as u, s.low as v, e.v <> s.low as moved
from {edges} e join {low} s on e.u = s.u
"""


def local_forests(edges: DataFrame) -> DataFrame:
    """``edges`` with each partition's edges replaced by a spanning forest of them; no exchange."""
    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(spanning_forest, "u bigint, v bigint")


def connected_components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """Labels ``(node, root)`` of all nodes that are not the smallest of their component.

    ``edges`` must be a written table. The driver only sees how many edges a round has moved.
    """
    spark = edges.sparkSession
    forest = ws.scratch()
    start, _ = forest.save(local_forests(edges), "forest")
    current, owner, moved = start, forest, 1
    while moved:
        scratch = ws.scratch()
        low, _ = scratch.save(spark.sql(_LOWEST, edges=current), "lowest")
        large, seen = scratch.save(
            spark.sql(_LARGE, edges=current, low=low), "large", moved=F.count_if("moved")
        )
        moved = seen["moved"]
        low, _ = scratch.save(spark.sql(_LOWEST, edges=large), "lowest")
        watched = Observation()
        small = spark.sql(_SMALL, edges=large, low=low).observe(watched, F.count_if("moved").alias("moved"))
        following = ws.scratch()
        current, _ = following.save(small.select("u", "v").distinct(), "star")
        moved += watched.get["moved"]
        scratch.close()
        if owner:
            owner.close()
        owner = following
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def component_labels(nodes: DataFrame, labels: DataFrame, node: str = "id") -> DataFrame:
    """All nodes with their component; a node without an edge is a component of its own."""
    return nodes.join(labels.withColumnRenamed("node", node), node, "left").withColumn(
        "root", F.coalesce("root", node)
    )


def size_stats(labels: DataFrame, label: str = "root") -> DataFrame:
    """Clusters, singletons, and number, mean and largest size of the others."""
    sizes = labels.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    multi = F.when(F.col("size") > 1, F.col("size"))
    return sizes.agg(
        F.count(F.lit(1)).alias("clusters"),
        F.count_if(F.col("size") == 1).alias("singletons"),
        F.count(multi).alias("multi_member_clusters"),
        F.avg(multi).alias("avg_multi_size"),
        F.max(multi).alias("max_size"),
    )
