"""Connected components of an edge table too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.session import materialize


def _smallest_neighbour(edges: DataFrame, key: str, other: str) -> DataFrame:
    return edges.groupBy(key).agg(F.min(other).alias("_least"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node reachable), one row per node of an edge.

    Alternates two steps until the edges form stars: every node's larger
    neighbours are hung on its smallest one, then its smaller neighbours too.
    The number of rounds grows with the logarithm of the number of nodes; no
    step gathers a node's neighbours. Each round is written to the shared
    folder, so a lost executor never recomputes earlier ones. Rows with a NULL
    end and loops are ignored.
    """
    current = materialize(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b")))
        .distinct()
    )
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_least")).withColumn("_least", F.least("a", "_least"))
        # Here a stands for the centre, and b for its neighbours.
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()
        )
        large = materialize(large.filter("a != b"))
        least = _smallest_neighbour(large, "a", "b")
        hung = large.join(least, "a")
        small = hung.select(F.col("b").alias("a"), F.col("_least").alias("b")).filter("a != b")
        small = materialize(small.union(least.select("a", F.col("_least").alias("b"))).distinct())
        # Stars, if no node hangs on two others, or on one while others hang on it: one job tells.
        ends = small.select(F.col("a").alias("node"), F.lit(1).alias("hung"), F.lit(0).alias("head")).union(
            small.select("b", F.lit(0), F.lit(1))
        )
        ends = ends.groupBy("node").agg(F.sum("hung").alias("hung"), F.max("head").alias("head"))
        if ends.filter("hung + head > 1").count() == 0:
            break
        current = small
    roots = small.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return small.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
