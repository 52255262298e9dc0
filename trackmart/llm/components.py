"""Connected components of an edge table, by alternating large-star and
small-star steps on tables in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the least node
    reachable. Loops and repeated edges are harmless, rows with a null end are
    ignored, no edge gives no row.

    Every step is a minimum per node (combined before the shuffle) joined back
    to the edges, so a node with very many edges is split like any skewed
    join; the number of steps grows with the logarithm of a component's size.
    """
    pairs = (edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
             .where(F.col("hi").isNotNull() & F.col("lo").isNotNull() & (F.col("hi") != F.col("lo"))))
    while True:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours of u hang on the least of u's neighbourhood.
        large = both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        # Small star: u and its smaller neighbours hang on the least of them.
        small = large.join(large.groupBy("hi").agg(F.min("lo").alias("m")), "hi")
        small = (small.select("hi", F.col("m").alias("lo"))
                 .unionByName(small.where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct())
        pairs = stored(small, "cc-step")
        # Done when no node hangs on two others, or on one and has others on it.
        ends = pairs.select(F.col("hi").alias("node"), F.lit(2).alias("n")).unionByName(pairs.select(F.col("lo").alias("node"), F.lit(1).alias("n")).distinct())
        if not ends.groupBy("node").agg(F.sum("n").alias("n")).where("n > 2").limit(1).count():
            break
    roots = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
