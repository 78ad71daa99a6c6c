"""Connected components of a link table, smallest label per component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node of ``links``
    (a, b; undirected, no self links).

    Randomised contraction: in each round every node takes, of itself and its
    neighbours, the one first in an order drawn by hash for that round; nodes
    with one choice become one node of the next round, links inside it vanish.
    An order drawn anew keeps at most three quarters of the nodes on average
    whatever the shape of the component, so the rounds grow with the logarithm
    of its nodes and need no cap: they end when no link is left. The choices
    are then followed back from the last round to the first, and the smallest
    node of each component is a map-side combined ``min``.

    The joins are plain joins of materialised tables, which adaptive execution
    splits when one component holds most rows. All tables live in the shared
    checkpoint folder, never on the driver."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    rounds: list[DataFrame] = []
    while not rounds or not both.isEmpty():
        place = F.xxhash64(F.lit(len(rounds)), "b")      # one-to-one on longs: no ties
        own = F.xxhash64(F.lit(len(rounds)), "a")
        chosen = cut(both.groupBy("a").agg(F.min_by("b", place).alias("b"), F.min(place).alias("first"))
                     .select(F.col("a").alias("node"), F.when(own < F.col("first"), F.col("a")).otherwise(F.col("b")).alias("root")))
        rounds.append(chosen)
        left = both.join(chosen.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").select("ra", "b")
        both = cut(left.join(chosen.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
                   .filter("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    roots = rounds.pop()
    while rounds:
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("far"))
        roots = cut(rounds.pop().join(later, "root", "left").select("node", F.coalesce("far", "root").alias("root")))
    smallest = cut(roots.groupBy("root").agg(F.min("node").alias("smallest")))
    return roots.join(smallest, "root").select("node", F.col("smallest").alias("root"))
