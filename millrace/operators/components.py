"""Connected components by breadth-first search from many seeds at once.

Each level works on a hash-partitioned adjacency list. Seeds are the nodes of a quarter of the hash range and every
node whose hash is the least among its neighbours; all seeds' frontiers grow together for a few rounds, and a node
keeps the least seed label that reaches it (nodes not reached start their own label). Where frontiers of different
seeds touch, their labels collide: the collisions are the edges of a smaller graph of labels, on which the next level
works in the same way, until no edge is left. Nothing of the graph is collected; lineage is cut by stashed tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import stash, unstash

#: Frontier rounds in a level, and the share of nodes (one in so many) that are seeds by their hash alone.
ROUNDS, SEED_ONE_IN = 2, 4
#: Levels after which a graph that still has edges is an error. Each level at least halves the nodes with edges.
MOST_LEVELS = 60


def _level(edges: DataFrame, level: int) -> DataFrame:
    """(node, label) for every node with an edge; ``edges`` has both directions as (u, v)."""
    rank = lambda c: F.xxhash64(F.lit(level), c)
    nodes = edges.groupBy("u").agg(F.min(rank("v")).alias("least"))
    own = rank("u")
    seed = (own < F.col("least")) | (F.pmod(own, F.lit(SEED_ONE_IN)) == 0)
    state = nodes.select(F.col("u").alias("node"), F.when(seed, F.col("u")).alias("label"))
    for _ in range(ROUNDS):
        # A node that has its label doesn't change any more: the search only goes outward.
        seen = state.where("label is not null").select(F.col("node").alias("v"), F.col("label").alias("_reach"))
        reach = edges.join(seen, "v").groupBy(F.col("u").alias("node")).agg(F.min("_reach").alias("_reach"))
        state = state.join(reach, "node", "left").select("node", F.coalesce("label", "_reach").alias("label"))
    return state.select("node", F.coalesce("label", "node").alias("label"))


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its least node.

    Direction, repeated edges and loops don't matter; a node with loops only is its own component. Edges with a null
    end are ignored. An empty frame of edges gives an empty result.
    """
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
    alone = e.where("u = v").select(F.col("u").alias("node")).distinct()
    e = e.where("u <> v")
    current = stash(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    maps: list[DataFrame] = []
    for level in range(MOST_LEVELS):
        if current.isEmpty():
            break
        labels = stash(_level(current, level), "labels")
        maps.append(labels)
        a = labels.select(F.col("node").alias("u"), F.col("label").alias("lu"))
        b = labels.select(F.col("node").alias("v"), F.col("label").alias("lv"))
        met = current.join(a, "u").join(b, "v").where("lu <> lv")
        following = stash(met.select(F.col("lu").alias("u"), F.col("lv").alias("v")).distinct(), "edges")
        unstash(current)
        current = following
    else:
        raise RuntimeError("components: the graph didn't contract")
    unstash(current)
    if not maps:
        return alone.select("node", F.col("node").alias("component"))
    out = maps[0]
    for following in maps[1:]:
        step = following.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        out = out.join(step, "label", "left").select("node", F.coalesce("_next", "label").alias("label"))
    names = out.groupBy("label").agg(F.min("node").alias("component"))
    out = out.join(names, "label").select("node", "component")
    rest = alone.join(out, "node", "left_anti").select("node", F.col("node").alias("component"))
    return out.unionByName(rest)
