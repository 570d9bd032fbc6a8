"""Connected components of links, without gathering them anywhere.

Large-star and small-star steps alternate: each node's neighbours are tied to the
smallest node in reach, until every component is a star around its smallest node.
A node with very many neighbours costs a partial minimum and a join on its key that
adaptive execution splits.

``bucket_components`` finds the links to begin with.  Nodes that share a bucket are
candidates, but a bucket may hold a whole family of like nodes, so pairs within it are not
listed.  Each member meets the bucket's pivot, the member that shares most buckets with
others.  Only where a bucket then still holds several components are its members outside
the largest one compared with the members of other components, all of them: no link that
could join two components is left out.  These are met as pairs, or, where a function for
it is given, in blocks: buckets of one pivot are one group, its members outside the largest
component are dealt into blocks, and all members pass by each block once, so nothing is
made for each pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Tables

#: Members that a block holds, on average.
BLOCK = 256


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Expects u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node is tied to one other, and that one to none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("tied")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("tied")))
    seen = ends.groupBy("node").agg(F.sum("tied").alias("ties"), F.min("tied").alias("least"))
    return seen.where("ties > 1 or (ties = 1 and least = 0)").isEmpty()


def components(links: DataFrame, tables: Tables, most_rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (smallest node in reach) of every node that isn't itself
    the smallest; ``links`` has columns a, b of comparable values.

    Links of a node to itself, repeated links and either direction are fine; no links: no
    rows.
    """
    edges = tables.written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        if _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        tied = tables.written(_small_star(_large_star(edges)), "edges")
        tables.drop(edges)
        edges = tied
    raise RuntimeError(f"components have not settled in {most_rounds} rounds")


def outside_largest(placed: DataFrame, key: str) -> DataFrame:
    """Rows of the keys that hold several components; ``outside``: not in the largest."""
    largest = (
        placed.groupBy(key, "component").agg(F.count("*").alias("own"))
        .groupBy(key).agg(F.max_by("component", F.struct("own", -F.col("component"))).alias("largest"), F.count("*").alias("parts"), F.sum("own").alias("size")).where("parts > 1")
    )
    return placed.join(largest, key).withColumn("outside", F.col("component") != F.col("largest")).drop("largest", "parts")


def bucket_components(entries: DataFrame, fits: Callable[[Column, Column], Column], linked: Callable[[DataFrame, DataFrame], DataFrame], linked_in_blocks: Callable[[DataFrame], DataFrame], tables: Tables) -> DataFrame:
    """``node``, ``component`` as ``components`` gives them.

    ``entries``: ``band``, ``node`` (long), ``info``.  ``fits``: a cheap necessary condition
    on two infos.  ``linked(pairs, nodes)``: of the pairs (a < b) those that are linked;
    ``nodes`` has all nodes that a pair may have.  ``linked_in_blocks(rows)``: links (a, b)
    between the rows of a (pivot, block) that are ``held`` and all others of it.
    """
    # one shuffle serves the count and the join
    by_band = entries.repartition("band")
    shared = by_band.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = tables.written(by_band.join(shared, "band"), "members")
    weights = tables.written(members.groupBy("node").agg(F.sum("size").alias("weight"), F.first("info").alias("info")), "weights")
    nodes = weights.select("node", "info")
    weighed = members.drop("info", "size").join(weights, "node")
    pivots = weighed.groupBy("band").agg(F.max_by(F.struct("node", "info"), F.struct("weight", -F.col("node"))).alias("pivot"))
    met = members.join(pivots, "band").where((F.col("node") != F.col("pivot.node")) & fits(F.col("info"), F.col("pivot.info")))
    first = tables.written(met.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct(), "pairs")
    found = components(tables.written(linked(first, nodes), "links"), tables)

    placed = members.select("band", "node", "info").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = tables.written(placed.join(pivots.select("band", F.col("pivot.node").alias("pivot")), "band").select("pivot", "node", "component").distinct(), "groups")
    # a group of two is the pivot and a member, which have met
    mixed = tables.written(outside_largest(groups, "pivot").where("size > 2"), "mixed")
    blocks = mixed.where("outside").groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))
    dealt = mixed.join(blocks, "pivot")
    held = dealt.where("outside").select("pivot", F.pmod(F.xxhash64("node"), "n_blocks").cast("int").alias("block"), "node", "component", F.lit(True).alias("held"))
    passing = dealt.select("pivot", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), "node", "component", F.lit(False).alias("held"))
    more = tables.written(linked_in_blocks(held.unionByName(passing)), "links")
    if more.isEmpty():
        return found
    return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), tables)
