"""Connected components of an edge table, by alternating stars.

Large star: every node hands its larger neighbours to the smallest node it
knows. Small star: every node hands its smaller neighbours, and itself, to the
smallest of them. The edges turn into one star per component, around its
smallest node, after a number of rounds that is logarithmic in practice. A node
is a minimum and a join, never a list, so a hot node splits like any skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.scratch import Scratch


def _star(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) joined with the smallest v of each u, as column m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _star(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    return found.where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    found = _star(edges).select(
        F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x")
    )
    return found.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node that has an edge to another one.

    ``component`` is the smallest node that is reachable. Edges may repeat and
    point either way; an edge with a null end or from a node to itself links
    nothing; without edges the result is empty. Each round is written to the
    scratch folder and the one before it removed.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    stars = scratch.keep(
        edges.where(f"{a} <> {b}").select(high.alias("u"), low.alias("v")).distinct(), f"{name}-0"
    )
    mark = None
    step = 0
    while True:
        told = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if told == mark or not told[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                stars.select("v", "v").distinct()
            )
        mark = told
        step += 1
        stars = scratch.keep(_small(_large(stars)), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
