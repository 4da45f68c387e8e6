"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import discard, keep_once


def _towards_least(edges: DataFrame, both: bool) -> DataFrame:
    """One star step.  Each node's neighbours are linked to the least node of its neighbourhood: the larger neighbours if
    both directions are looked at, the smaller ones otherwise."""
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).filter("node <> other")
    view = down.unionByName(down.select(F.col("other").alias("node"), F.col("node").alias("other"))) if both else down
    least = view.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least"))
    linked = view.filter("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b")) if both else view.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    if not both:
        linked = linked.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return linked.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of edges (a, b: long) with the least node that it is connected to.

    Rounds: about the logarithm of the nodes.  Each round's edges are a table in the shared folder; the driver sees two
    numbers a round, with which it tells that nothing moved.
    """
    spark = edges.sparkSession
    now, path = keep_once(edges.select("a", "b").filter("a <> b"), "edges")
    before = None
    while True:
        then, then_path = keep_once(_towards_least(_towards_least(now, True), False), "edges")
        discard(spark, path)
        now, path = then, then_path
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
