"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.sources.scratch import materialize


def _to_smallest(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    return both.join(least, "a").where("b > a and b != m").selectExpr("b as a", "m as b").distinct()


def _to_parent(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = materialize(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = links.join(least, "a").where("b != m").selectExpr("b as a", "m as b")
    return moved.union(least.selectExpr("a", "m as b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``, long) that is
    not itself the smallest of its component; ``component`` is that smallest
    node.  Self-links and nulls are ignored, repeated links count once.

    Every round rewires nodes towards the smallest neighbour, with the
    minimum pre-aggregated before the shuffle, and is written to the shared
    scratch folder.  The minima are written too: the join back is then apart
    from their aggregate, and a hot node's links can be split.  Rounds grow with the logarithm of a component's width.
    Only a count and a checksum reach the driver."""
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    before = None
    while True:
        state = links.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        links = materialize(_to_parent(_to_smallest(links)), "links")
