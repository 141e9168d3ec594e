"""Connected components of a graph given as edges; joins and grouping only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidedesk.session import materialize


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select("b", "a"))


def _jump(parents: DataFrame) -> DataFrame:
    """``id, parent`` with each parent replaced by its own parent."""
    above = parents.select(F.col("id").alias("_p"), F.col("parent").alias("_above"))
    return parents.join(above, F.col("parent") == F.col("_p"), "left").select("id", F.coalesce("_above", "parent").alias("parent"))


def components(edges: DataFrame) -> DataFrame:
    """``id, label``: for each end of an edge ``(a, b)`` of longs, the smallest id that it reaches.

    Contraction: every vertex takes its smallest neighbour, if smaller, as parent; parents of parents
    are taken twice; edges are rewritten to parents and those that fall together go. At least half of
    the vertices of every open component vanish per round, so all rounds together cost little more than
    the first. Minima are combined before each shuffle, a vertex with very many neighbours lies on the
    side of the join that Spark can split, and each round is written down.
    """
    live = materialize(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "component-edges")
    labels = materialize(_ends(live).select(F.col("a").alias("id")).distinct().withColumn("label", F.col("id")), "component-labels")
    while live.limit(1).count():
        parents = materialize(
            _ends(live).groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("parent")), "component-parents")
        parents = materialize(_jump(_jump(parents)), "component-parents")
        up = parents.select(F.col("id").alias("_i"), F.col("parent").alias("_up"))
        labels = materialize(
            labels.join(up, F.col("label") == F.col("_i"), "left").select("id", F.coalesce("_up", "label").alias("label")), "component-labels")
        moved = live.join(up, F.col("a") == F.col("_i")).select(F.col("_up").alias("a"), "b")
        moved = moved.join(up, F.col("b") == F.col("_i")).select("a", F.col("_up").alias("b")).filter("a <> b")
        live = materialize(
            moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "component-edges")
    return labels
