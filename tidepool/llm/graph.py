"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import gathered, stored


def components(edges: DataFrame, nodes: int = 0) -> DataFrame:
    """``(node, root)`` of every node of an edge: ``root`` is the smallest node it reaches.

    ``edges`` has two bigint columns ``u`` and ``v``, in any direction, repeats
    and loops allowed; ``nodes``, if known, sizes the tables.  Every round replaces a node's neighbours by links to the
    smallest of them; the number of rounds grows with the logarithm of the
    longest path.  Each round is a stored table, and no node's neighbours ever
    meet in one row.  A table of no edges gives no rows.
    """
    now = stored(gathered(_oriented(edges), nodes), "edges")
    state = _state(now)
    while True:
        now = stored(gathered(_small_star(_large_star(now)), nodes), "edges")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _oriented(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(least.select("u", F.col("m").alias("v")).unionByName(others))
