"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.sources.scratch import stage


def _to_minimum(links: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours of every node on the smallest node around it.

    ``larger``: each node's larger neighbours; otherwise its smaller ones and
    itself. Only a minimum per node is gathered, so that a node with many
    neighbours does not meet in one task.
    """
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.filter(F.col("b") > F.col("a")).join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of ``links(a, b)``; the component is its smallest node.

    Links may repeat, point either way or from a node to itself. Large and
    small stars alternate until nothing moves, which takes about the logarithm
    of the longest chain; every round is written to the shared folder.
    """
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    stars = stage(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        now = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or now == state:
            break
        state = now
        stars = stage(_to_minimum(_to_minimum(stars, True), False), "links")
    return nodes.join(stars.select(F.col("a").alias("node"), F.col("b").alias("_root")), "node", "left").select("node", F.coalesce("_root", "node").alias("component"))
