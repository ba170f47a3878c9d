"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.storage import discard, materialize


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its least node.

    Each round hangs every node's larger neighbours under its least one (large star), then its
    smaller neighbours likewise (small star), until the edges no longer change: about the logarithm
    of the number of nodes.  Edges and labels stay in tables; two numbers a round reach the driver.
    """
    pairs = edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).where("a <> b")
    now = materialize(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        small = materialize(small, "small")
        discard(now, large)
        now = small
        mark = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    named = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
    named = materialize(named, "components")
    discard(now)
    return named
