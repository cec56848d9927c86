"""Connected components of a large edge table, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpwise.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a`` and ``b``, longs); a component is named by its smallest node.

    In each round every node moves to the neighbour (or itself) with the least
    keyed hash, and edges are drawn anew between the nodes moved to. Random
    priorities shrink chains and stars alike by a constant factor per round, so
    the number of rounds grows with the logarithm of the input. Each round's
    tables are written to the shared folder; nothing but counts reaches the driver.
    """
    edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(7)).alias("rank"), F.col(c).alias("to"))
    while edges.limit(1).count():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = staged(both.groupBy("a").agg(F.min(rank("b")).alias("best")).select(F.col("a").alias("from"), F.least("best", rank("a"))["to"].alias("to")), "moves")
        for end in ("a", "b"):
            edges = edges.join(moves, F.col(end) == F.col("from")).withColumn(end, F.col("to")).drop("from", "to")
        edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        labels = staged(labels.join(moves, F.col("label") == F.col("from"), "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
    named = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(named, "label").select("node", "component")


def roots(n: int, pairs: Iterator[tuple[int, int]]) -> list[int]:
    """Smallest index of each index's component."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
