"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.session import written


def _least(both_ways: DataFrame) -> DataFrame:
    least = both_ways.groupBy("u").agg(F.min("v").alias("m"))
    return both_ways.join(
        least.select(F.col("u"), F.least("u", "m").alias("m")), "u"
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for each id that has an edge.

    Large stars hang a node's greater neighbours on its least neighbour; small
    stars do so with the lesser ones. Rounds grow with the logarithm of the
    longest path. Each round is two aggregates that combine before their shuffle
    and two equi-joins, and its edges are written to the shared folder, so a lost
    executor costs one round at most and no list of neighbours is ever gathered.
    """
    stars = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    while not _is_stars(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _least(large)
        hung = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = small.select("u", F.col("m").alias("v"))
        stars = written(hung.unionByName(own).where("u <> v").distinct(), "edges")
    out = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return out.unionByName(roots)


def _is_stars(edges: DataFrame) -> bool:
    """True when each larger end has one edge and no smaller end is a larger end."""
    if edges.groupBy("u").count().where("count > 1").limit(1).count():
        return False
    return edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count() == 0
