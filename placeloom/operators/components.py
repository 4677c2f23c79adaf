"""Connected components by rounds of large-star and small-star.

Every round is written out, so lineage stays short and a lost executor costs one round; a hot node is a key of
aggregates with map-side sums and of a join that Spark may split, never a group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (u, v): the least node that each is linked with in any number of steps.

    Nodes compare by their value; an edge of a node with itself is none, and its node isn't returned for it.
    """
    facts = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))

    current, before = stored.observed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", *facts)
    for _ in range(most_rounds if before["n"] else 0):
        # large star: all larger neighbours of a node move to its least neighbour (itself included)
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moved = both.join(least(both), F.col("u") == F.col("at")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored.table(moved, "large")
        # small star: a node and its smaller neighbours move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), "m")
        small = large.join(low, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select(F.col("at").alias("u"), F.col("m").alias("v"))).distinct()
        current, after = stored.observed(small, "edges", *facts)
        if after == before:
            break
        before = after
    else:
        if before["n"]:
            raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
