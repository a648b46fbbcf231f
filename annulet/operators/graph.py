"""Graphs as edge tables: connected components, degrees, closure and simple cycle tests.

Components by alternating large-star and small-star steps on edges (each node is linked to the smallest neighbour
it knows), which takes a logarithmic number of rounds; each round is a checkpoint in the shared folder, so an
executor may be lost at any time. Edges are pre-aggregated to distinct pairs; a node with very many neighbours is
handled by aggregates that combine map-side. Null ends drop out; isolated nodes come from the node table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annulet.session import cut


def _digest(edges: DataFrame) -> tuple:
    """What distinct edges are told apart by: how many, and two sums over hashes of them."""
    key = lambda seed: F.xxhash64(F.lit(seed), "u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(key(1)), F.sum(key(2))).first())


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, component (its smallest node) from nodes (node) and edges (src, dst)."""
    star = cut(edges.where("src is not null and dst is not null and src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    before = _digest(star)
    for _ in range(most_rounds):
        # Large star: neighbours above a node move to the smallest of its neighbours and itself.
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its smaller neighbours move to the smallest of these.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        fresh = cut(small)
        after = _digest(fresh)
        star, same, before = fresh, after == before, after
        if same:
            break
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    roots = star.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.select("node").distinct().join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))


def degrees(edges: DataFrame) -> DataFrame:
    """node, degree; parallel edges count, a loop counts twice."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def circular(members: DataFrame, edges: DataFrame) -> DataFrame:
    """component, nodes, edges, loop, cyclic.

    One node is circular by a loop; two nodes if there are edges both ways and no node has more than two edges; more
    if there is a cycle among distinct pairs and no node has more than two edges.
    """
    placed = edges.join(members.select(F.col("node").alias("src"), "component"), "src")
    deg = degrees(edges).join(members, "node").groupBy("component").agg(F.max("degree").alias("most"))
    sizes = members.groupBy("component").agg(F.count("*").alias("nodes"))
    facts = placed.groupBy("component").agg(
        F.count("*").alias("edges"), F.max(F.col("src") == F.col("dst")).alias("loop"),
        F.countDistinct(F.when(F.col("src") != F.col("dst"), F.struct(F.least("src", "dst"), F.greatest("src", "dst")))).alias("pairs"),
        F.countDistinct(F.when(F.col("src") != F.col("dst"), F.struct("src", "dst"))).alias("ways"),
    )
    out = sizes.join(facts, "component", "left").join(deg, "component", "left").na.fill(0, ["edges", "pairs", "ways", "most"]).na.fill(False, ["loop"])
    cyclic = F.when(F.col("nodes") == 1, F.col("loop")).when(F.col("nodes") == 2, (F.col("ways") == 2) & (F.col("most") <= 2)).otherwise((F.col("pairs") >= F.col("nodes")) & (F.col("most") <= 2))
    return out.withColumn("cyclic", cyclic).select("component", "nodes", "edges", "loop", "cyclic")
