"""Connected components of an edge table, by contraction to local minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for every vertex with an edge; label is the smallest id of its component.

    A round points every vertex to the smallest of its neighbours and itself,
    follows the pointers to their roots (each step doubles the way), and
    replaces the edges by those between different roots, until none is left.
    Edges shrink with each round. Steps are stored tables; joins are between
    stored tables, so the partition of a hub can be split.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    pairs = stored(pairs, "edges")
    labels = None
    while not pairs.isEmpty():
        ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        root = roots(stored(ends.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("label")), "labels"))
        if labels is None:
            labels = root
        else:
            of = root.select(F.col("id").alias("label"), F.col("label").alias("next"))
            labels = stored(labels.join(of, "label", "left").select("id", F.coalesce("next", "label").alias("label")), "labels")
        at = lambda c: root.select(F.col("id").alias(c), F.col("label").alias(f"{c}{c}"))
        moved = pairs.join(at("a"), "a").select("aa", "b").join(at("b"), "b").select(F.col("aa").alias("a"), F.col("bb").alias("b"))
        pairs = stored(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if labels is None:
        return pairs.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return labels


def roots(labels: DataFrame) -> DataFrame:
    """Follow the labels until every one is its own label."""
    while True:
        of = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = stored(labels.join(of, "label").select("id", F.col("label").alias("was"), F.col("next").alias("label")), "labels")
        labels = jumped.select("id", "label")
        if jumped.where("was <> label").isEmpty():
            return labels
