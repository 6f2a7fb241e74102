"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dvspark.llm.common import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``edges``.

    Each round, every node hands the smallest node it sees to all its larger
    neighbours, then every node hands the smallest to all its smaller ones:
    trees of any shape become stars in a number of rounds that grows with the
    logarithm of their size.  A node's neighbours are summed up by a minimum
    before any join, so no neighbourhood is gathered in one task.  Each round
    is written to the shared folder; only the number of changed rows reaches
    the driver.  No edges: no rows.
    """
    spark = edges.sparkSession
    x, y = F.col(a), F.col(b)
    now = stored(edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges")
    while True:
        # Large star: all larger neighbours of a node go to the smallest node around it.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: all smaller neighbours of a node, and itself, go to the smallest of them.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # Stars whose leaves have one edge and whose centres are nobody's leaf: done.
        many = after.groupBy("u").count().where("count > 1").limit(1).count()
        inner = many or after.join(after.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count()
        now = after
        if not inner:
            break
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
