"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.operators.skew import skew_lookup
from quarrystone.session import materialize

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root): the least node of each node's component.

    Large and small stars alternate until nothing moves; every round is two
    grouped minima (combined map-side) and lookups by node, written to the shared
    folder, so the lineage stays short; the edges of a hub, such as the root of
    a large component, are looked up where they lie, so no task holds one. Nodes
    without edges do not occur. Edges with a null end and self-loops are
    dropped, repeated ones merged.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    current = materialize(pairs.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: each node's greater neighbours are tied to the least node it knows
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("_rows")), "cc-least")
        large = skew_lookup(both, least, ["u"], "_rows").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        # small star: each node and its lesser neighbours are tied to the least of them
        lesser = materialize(large, "cc")
        least = materialize(lesser.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_rows")), "cc-least")
        small = skew_lookup(lesser, least, ["u"], "_rows").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        current = materialize(small.where(F.col("u") != F.col("v")).distinct(), "cc")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
