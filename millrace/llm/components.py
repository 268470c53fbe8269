"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import Workspace


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """Edges (a, b) to (id, label): each node of an edge and the smallest node of its component.

    Alternates two steps until nothing changes: each node links its larger neighbours to its smallest one, then its smaller
    neighbours. The edges never grow in number, and a few rounds suffice (logarithmic in the longest chain).
    """
    now = work.cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = fingerprint(now)
    while True:
        # large star: every neighbour above a node goes to the lowest of its neighbourhood
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its lower neighbours go to the lowest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        after = work.cut(small, "edges", free=False)
        last, seen = seen, fingerprint(after)
        work.drop(now)
        now = after
        if seen == last:
            return now.select(F.col("u").alias("id"), F.col("v").alias("label"))


def fingerprint(edges: DataFrame):
    """Equal for equal sets of edges, in one pass without a shuffle of rows."""
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
