"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import stored

MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """``a, b`` with ``least``, the smaller of ``a`` and all its ``b``. The minima come from a partial aggregation
    and a join, so that the rows of a node with very many neighbours can be split over tasks."""
    minima = edges.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return edges.join(minima, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _least(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = _least(down)
    return (stars.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(stars.select("a", F.col("least").alias("b"))).where("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node that occurs in ``links`` (columns a, b).

    Self-links and repeated links do no harm; null ends are left out. Each round
    is written to the shared folder, so no lineage grows.
    """
    edges = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = stored(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    # every edge now leads from a node to the smallest node of its component
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
