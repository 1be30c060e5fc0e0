"""Connected components of links stored in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbrow.llm.common import stage


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node, root (the smallest node reachable) of every node in links (a, b: long).

    Alternates the large-star and small-star steps until the links are stars; each round stores its links
    in the shared folder. Minima are taken by map-side aggregation, so a node with very many
    neighbours is no burden; its join is split by the adaptive planner.
    """
    links = stage(_tidy(links), "links")
    for _ in range(most_rounds):
        if _are_stars(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b"), F.col("b")).distinct()
            )
        links = stage(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"links did not settle in {most_rounds} rounds")


def _tidy(links: DataFrame) -> DataFrame:
    """Each link once, as (greater, smaller)."""
    return links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _are_stars(links: DataFrame) -> bool:
    """No node has two smaller neighbours, or a smaller and a greater one."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down > 1 OR down = 1 AND up = 1").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Link each greater neighbour of a node to the smallest of its neighbours and itself."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    least = least.select("node", F.least("node", "m").alias("m"))
    # Links run from the greater to the smaller node, so b's greater neighbours are the a's.
    return _tidy(links.join(least, F.col("b") == F.col("node")).select("a", F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of these."""
    least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    joined = links.join(least, F.col("a") == F.col("node"))
    return _tidy(
        joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
    )
