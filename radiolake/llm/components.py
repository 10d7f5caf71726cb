"""Connected components of a table of links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolake.session import stage


def _ordered(links: DataFrame, a: str, b: str) -> DataFrame:
    return links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of the links (a, b); label is the least node it is connected with.

    Rounds of contraction. In each, a node points at the least node among itself and its neighbours,
    then at what that one points at; links between nodes that do not yet point at one node go into
    the next round as links between those nodes, so the first round costs most. The least node of a
    component always points at itself, and all others end at it. Pointers are written each round: a
    lost executor costs one round, and lineage stays short. Only the question whether links are left
    comes to the driver.
    """
    open_links = stage(_ordered(links.filter("a <> b"), "a", "b"), "links")
    levels = []
    while open_links.limit(1).count():
        swapped = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
        ends = open_links.select(F.explode(F.array(F.struct("a", "b"), swapped)).alias("e")).select("e.*")
        near = ends.groupBy("a").agg(F.min("b").alias("b"))
        pointer = stage(near.select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "near")
        target = pointer.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = stage(pointer.join(target, "up").select("node", F.col("top").alias("up")), "pointers")
        levels.append(jumped)
        left = jumped.select(F.col("node").alias("a"), F.col("up").alias("pa"))
        right = jumped.select(F.col("node").alias("b"), F.col("up").alias("pb"))
        joined = open_links.join(left, "a").join(right, "b").filter("pa <> pb")
        open_links = stage(_ordered(joined, "pa", "pb"), "links")
    if not levels:
        node = links.schema["a"].dataType.simpleString()
        return links.sparkSession.createDataFrame([], f"node {node}, label {node}")

    def followed(labels: DataFrame, level: DataFrame) -> DataFrame:
        upper = level.select(F.col("node").alias("label"), F.col("up").alias("next"))
        return labels.join(upper, "label", "left").select("node", F.coalesce("next", "label").alias("label"))

    first = levels[0].select("node", F.col("up").alias("label"))
    labels = reduce(followed, levels[1:], first)
    return stage(labels, "labels")
