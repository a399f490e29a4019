"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.llm.common import Scratch


def large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node with the smallest node next to it. ``edges``: u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours with the smallest of them. ``edges``: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def at_rest(edges: DataFrame) -> bool:
    """Are the links stars around smallest nodes? ``edges``: u > v, different. Then each u has one link, and no v is itself a u."""
    ends = edges.select(F.explode(F.array(*[F.struct(F.col(c).alias("node"), F.lit(c == "u").cast("long").alias("ups"), F.lit(c == "v").alias("center")) for c in ("u", "v")])).alias("x"))
    nodes = ends.groupBy("x.node").agg(F.sum("x.ups").alias("ups"), F.max("x.center").alias("center"))
    return nodes.where((F.col("ups") > 1) | ((F.col("ups") > 0) & F.col("center"))).isEmpty()


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) of every node that has a link, the component being its smallest node.

    ``links`` has two columns of node ids in any order; loops and repeated links change nothing. Joins and aggregates are by
    node with partial aggregation, so a node with millions of links isn't gathered in one place. Each round is written to the
    shared folder, which cuts the lineage. Links that are stars already need none.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v")).distinct()
    edges = scratch.save(edges, f"{name}_0")
    turn = 0
    while not at_rest(edges):
        turn += 1
        edges = scratch.save(small_star(large_star(edges)), f"{name}_{turn}")
        scratch.drop(f"{name}_{turn - 1}")
    # At rest the links are stars around each component's smallest node.
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
