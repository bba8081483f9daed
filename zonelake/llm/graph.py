"""Connected components by hooking, pointer jumping and contraction, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import stage


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(v, c): every vertex of an edge with the smallest vertex that it reaches.  No edges, no rows.

    Each round every vertex takes the smallest of itself and its neighbours, then what that one takes, and the edges go on
    between the vertices so taken until none is left.  The edge by which a vertex takes another is one of them, so that no
    connection is lost; the smallest vertex of a component always takes itself.  Rounds are about the logarithm of the
    longest path; each is written before the next.
    """
    there = edges.filter(F.col(left) != F.col(right)).select(F.col(left).alias("a"), F.col(right).alias("b"))
    both = stage(there.unionByName(there.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = None
    while True:
        taken = both.groupBy(F.col("a").alias("v")).agg(F.least(F.first("a"), F.min("b")).alias("p"))
        onward = taken.select(F.col("v").alias("k"), F.col("p").alias("c"))
        taken = stage(taken.join(onward, F.col("p") == F.col("k")).select("v", "c"), "taken")
        if labels is None:
            labels = taken
        else:
            new = taken.select(F.col("v").alias("k"), F.col("c").alias("r"))
            labels = labels.join(new, F.col("c") == F.col("k"), "left").select("v", F.coalesce("r", "c").alias("c"))
            labels = stage(labels, "labels")
        one, two = taken.select(F.col("v").alias("a"), F.col("c").alias("x")), taken.select(F.col("v").alias("b"), F.col("c").alias("y"))
        moved = both.join(one, "a").join(two, "b").filter(F.col("x") != F.col("y"))
        both = stage(moved.select(F.col("x").alias("a"), F.col("y").alias("b")), "edges")
        if both.isEmpty():
            return labels
