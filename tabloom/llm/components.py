"""Connected components by rounds of random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.sources.shared import materialize


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``edges`` (columns a and b); component is the smallest vertex.

    In each round every vertex joins the one in its neighbourhood (itself included) with the smallest hash,
    and the edges between what is left go to the next round. The expected number of vertices falls by a
    constant factor, whatever the shape. Neighbourhoods are only ever reduced to a minimum, with map-side
    combine, so a vertex with very many edges is no large group. Each round is stored.
    """
    current = materialize(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    steps: list[DataFrame] = []
    while current.head():
        seed = F.lit(len(steps))
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c, seed), F.col(c))
        least = both.groupBy("a").agg(F.min(ranked("b")).alias("n"))
        parent = materialize(
            least.select(
                F.col("a").alias("vertex"),
                F.when(F.col("n") < F.struct(F.xxhash64("a", seed), F.col("a")), F.col("n.b")).otherwise(F.col("a")).alias("parent"),
            )
        )
        steps.append(parent)
        to = lambda side: parent.select(F.col("vertex").alias(side), F.col("parent").alias(f"p{side}"))
        moved = current.join(to("a"), "a").join(to("b"), "b").where("pa <> pb")
        current = materialize(
            moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
    if not steps:
        return current.select(F.col("a").alias("vertex"), F.col("a").alias("component"))
    roots = steps[0]
    for parent in steps[1:]:
        onward = parent.select(F.col("vertex").alias("parent"), F.col("parent").alias("next"))
        roots = roots.join(onward, "parent", "left").select("vertex", F.coalesce("next", "parent").alias("parent"))
    roots = materialize(roots)
    # A root is a vertex itself, so the smallest vertex of each root is the component's.
    smallest = roots.groupBy("parent").agg(F.min("vertex").alias("component"))
    return materialize(roots.join(smallest, "parent").select("vertex", "component"))


def joined_classes(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """(vertex, component) of the graph with the components ``classes`` and further ``edges``, which are few.

    Only the edges between classes, in place of their vertices, go through the rounds.
    """
    edges = materialize(edges)
    of = lambda side: classes.select(F.col("vertex").alias(side), F.col("component").alias(f"c{side}"))
    between = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    joined = components(between.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    onward = joined.select(F.col("vertex").alias("component"), F.col("component").alias("onward"))
    moved = classes.join(onward, "component", "left").select("vertex", F.coalesce("onward", "component").alias("component"))
    # Vertices that no class had before.
    fresh = joined.join(classes.select("vertex"), "vertex", "left_anti")
    return moved.unionByName(fresh)
