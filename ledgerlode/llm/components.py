"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlode.sources.files import discard, shared_root, stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``: the smallest node that can be reached.

    In each round every node points to the smallest of itself and its neighbours, and the links are drawn
    anew between the nodes pointed to; loops and doubles go. A node that is not the smallest of its
    neighbourhood disappears, so rounds grow with the logarithm of the longest path. Rounds are written to
    the shared folder. Links with a null end are ignored.
    """
    spark = links.sparkSession
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    path = shared_root(spark, "links")
    edges, labels, kept = stored(edges, "", path), None, None
    while not edges.isEmpty():
        # Each end of a link learns of the other; partial sums meet before the shuffle.
        both = edges.select(F.col("a").alias("node"), F.col("a").alias("near")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        points_path = shared_root(spark, "pointers")
        points = stored(both.groupBy("node").agg(F.min("near").alias("to")), "", points_path)
        left = points.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        drawn = (edges.join(left, "a").join(right, "b").where("to_a <> to_b")
                      .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                      .distinct())
        next_path = shared_root(spark, "links")
        edges = stored(drawn, "", next_path)
        discard(spark, path)
        path = next_path
        if labels is None:
            labels, kept = points.select("node", F.col("to").alias("component")), points_path
        else:
            step = points.select(F.col("node").alias("component"), "to")
            label_path = shared_root(spark, "labels")
            labels = stored(labels.join(step, "component", "left")
                                  .select("node", F.coalesce("to", "component").alias("component")), "", label_path)
            discard(spark, points_path)
            discard(spark, kept)
            kept = label_path
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
