"""Connected components of an edge list by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every end of ``edges`` (columns a, b): the smallest id reachable.

    Each round hooks every root to its smallest neighbouring root, follows the hooks twice and
    contracts the edges, so that only edges between different roots remain. Nothing is collected.
    Self loops give an id its own component; an empty table gives no rows. Only the result's table stays.
    """
    e = scratch.save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = scratch.save(e.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("component")))
    between = e.where("a <> b")
    while not between.isEmpty():
        hook = scratch.save(between.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("up")))
        far = hook.select(F.col("root").alias("up"), F.col("up").alias("up2"))
        hook2 = scratch.save(hook.join(far, "up", "left").select("root", F.coalesce("up2", "up").alias("up")))
        ends = lambda c: hook2.select(F.col("root").alias(c), F.col("up").alias(f"{c}_up"))  # noqa: E731, B023
        moved = between.join(ends("a"), "a", "left").join(ends("b"), "b", "left").select(F.coalesce("a_up", "a").alias("x"), F.coalesce("b_up", "b").alias("y"))
        contracted = scratch.save(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        new = scratch.save(labels.join(ends("component"), "component", "left").select("id", F.coalesce("component_up", "component").alias("component")))
        scratch.drop(labels, hook, hook2, e)
        labels, e, between = new, contracted, contracted
    scratch.drop(e)
    # A root may still point to a root that was hooked in the same round.
    return labels
