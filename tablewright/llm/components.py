"""Connected components of an edge table, by alternating large and small stars.

Both steps replace the edges around a node by edges to the least node near it, until every node points
at the least node of its component; the number of rounds grows with the logarithm of the longest path.
Minima are aggregates with map-side reduction and go back to the edges by joins that adaptive execution
may split, so a node with very many edges is no single task.  Every step is written to the shared
folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node in `edges` (columns `a, b`); nodes are of any type that has an order.

    Loops and nulls are ignored; repeated edges do no harm; no edges give an empty result.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(now, "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        seen = state
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        # large star: larger neighbours of a node go to its minimum
        large = now.join(least, F.col("b") == F.col("n")).select(F.col("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "large")
        # small star: smaller neighbours of a node, and itself, go to their minimum
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a <> b").union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
        now = materialize(small, "small")
