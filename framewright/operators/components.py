"""Connected components of a large graph by alternating large-star and small-star rounds (Kiveris et al., 2014).

Edges stay distributed. A round costs two joins whose hot side Spark can split, and two aggregations that
combine before they shuffle. Each round's edges are written to the shared folder, so a lost executor costs
a part of one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import dropped, written


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs(u, v): every pair once, u > v. Returns such pairs again."""
    if large:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        moved = pairs.join(least, "u")
        out = moved.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.distinct()


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link to another one; component is the smallest node reachable.

    Null ends and loops are ignored. Nodes must be longs. An empty table gives an empty table.
    """
    pairs = written(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(pairs)
    while mark[0]:
        after = written(_star(_star(pairs, True), False), "edges")
        dropped(pairs)
        pairs, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
