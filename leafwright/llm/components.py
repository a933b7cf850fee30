"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.llm.common import checkpointed


def _starred(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v.

    The large step ties each larger neighbour of a node to the least node around it;
    the small step ties the node and its smaller neighbours to the least of them. The
    least neighbour is a partial aggregate; a node with very many edges is split by the
    skew join, as both of its sides are read from the shared folder.
    """
    swapped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges if small else edges.unionByName(swapped)
    least = checkpointed(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    if small:
        joined = edges.join(least, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        moved = swapped.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return checkpointed(moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def components(links: DataFrame, limit: int = 60) -> DataFrame:
    """(id, component_id) of every node that has a link to another: the smallest node reachable.

    ``links`` has two long columns; direction, order and repeats don't matter, and links
    of a node to itself or to null are no links.
    """
    a, b = links.columns
    given = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = checkpointed(given.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    for _ in range(limit):
        if not state[0]:
            break
        edges = _starred(_starred(edges, small=False), small=True)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots.select("id", F.col("id").alias("component_id")))
