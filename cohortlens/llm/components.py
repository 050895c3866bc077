"""Connected components by contraction with random priorities: every round, each vertex joins the neighbour (or
itself) of least priority, and edges are relabelled; a constant share of the vertices goes away per round, whatever
the shape of the graph. Edges and labels stay distributed; nothing is collected. A round's steps are deleted and its
shuffles freed as soon as the next round has its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shared import dropped, freed_shuffles, stored


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(v, component), stored, for every vertex of ``edges`` (a, b); a component is named by its least vertex."""
    with freed_shuffles(edges.sparkSession):
        return _contracted(edges, rounds)


def _contracted(edges: DataFrame, rounds: int) -> DataFrame:
    spark = edges.sparkSession
    left = stored(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    for r in range(rounds):
        if left.isEmpty():
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.struct(F.xxhash64("b", F.lit(r)).alias("p"), F.col("b"))
        nearest = both.groupBy("a").agg(F.min(rank).alias("near"))
        to = stored(nearest.select(F.col("a").alias("v"), F.when(
            F.col("near.p") < F.xxhash64("a", F.lit(r)), F.col("near.b")).otherwise(F.col("a")).alias("t")))
        fa, fb = to.withColumnsRenamed({"v": "a", "t": "x"}), to.withColumnsRenamed({"v": "b", "t": "y"})
        before, left = left, stored(left.join(fa, "a").join(fb, "b").where("x <> y")
                                    .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        dropped(spark, [before])
        if labels is None:
            labels = to.withColumnRenamed("t", "label")
        else:
            before, labels = labels, stored(labels.join(to.withColumnRenamed("v", "label"), "label", "left")
                                            .select(labels["v"], F.coalesce("t", "label").alias("label")))
            dropped(spark, [before, to])
    else:
        raise RuntimeError(f"components did not converge in {rounds} rounds")
    if labels is None:
        return left.select(F.col("a").alias("v"), F.col("b").alias("component"))
    names = labels.groupBy("label").agg(F.min("v").alias("component"))
    found = stored(labels.join(names, "label").select("v", "component"))
    dropped(spark, [left, labels])
    return found


def joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components (v, component), stored, of ``connected`` after some more ``links`` (a, b): only the components that
    these join are contracted again, each as one vertex."""
    with freed_shuffles(comps.sparkSession):
        fa, fb = (comps.withColumnsRenamed({"v": v, "component": c}) for v, c in ("ax", "by"))
        between = connected(links.select("a", "b").join(fa, "a", "left").join(fb, "b", "left")
                            .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
        grown = between.select(F.col("v").alias("component"), F.col("component").alias("grown"))
        new = between.join(comps.select("v"), "v", "left_anti")  # vertices without a link so far
        found = stored(comps.join(grown, "component", "left").select("v", F.coalesce("grown", "component").alias("component"))
                       .unionByName(new))
        dropped(comps.sparkSession, [between])
        return found
