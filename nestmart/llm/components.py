"""Connected components by alternating large-star and small-star steps.

Nothing of the graph reaches the driver: each round is two grouped joins,
written to the shared folder, and the driver sees one count and one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmart.session import materialize


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of every node on its smallest neighbour (itself included)."""
    lowest = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    joined = pairs.join(lowest, "u")
    moved = joined.filter("v > u" if large else "v <= u").select(F.col("v").alias("u"),
                                                                 F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(lowest.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u long, v long); root is the smallest node.

    Edges may repeat and point either way; loops are ignored. An empty table
    gives no rows. Rounds: about log2 of the longest chain.
    """
    state = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u <> v").distinct(), "components")
    seen = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen or not now[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = tuple(now)
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        grown = _star(both, large=True)
        state = materialize(_star(grown.select(F.greatest("u", "v").alias("u"),
                                               F.least("u", "v").alias("v")), large=False),
                            "components")
