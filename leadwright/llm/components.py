"""Connected components of a table of links, by alternating star operations on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Join neighbours to the smallest of a node's neighbourhood: those above it (large) or those below it (small)."""
    sides = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        sides = sides.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    met = sides.join(least, "u")
    if large:
        out = met.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = met.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.filter("a <> b").distinct()


def component_labels(links: DataFrame) -> DataFrame:
    """key, comp: for every node of the links (columns a, b) the smallest node it is connected with.

    Every round writes its links, so a lost executor repeats one round at most; the driver sees one sum a round.
    """
    now = tools.materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links-0")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64(F.least("a", "b"), F.greatest("a", "b")).cast("decimal(20,0)")).alias("s")).first()
        if not state["n"] or state == before:
            break
        before = state
        large = _stars(now, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = _stars(large, False).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        now = tools.materialise(small.distinct(), "links-next")
    children = now.select(F.col("a").alias("key"), F.col("b").alias("comp"))
    return children.unionByName(children.select(F.col("comp").alias("key"), "comp").distinct())
