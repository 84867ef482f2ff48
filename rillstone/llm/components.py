"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Links up to which one task joins them; more are contracted by joins. Both give the same components.
FEW = 500_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and component of the links of all batches."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(parent.setdefault(u, u) if u not in parent else u), root(parent.setdefault(v, v) if v not in parent else v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "component"])


def components(links: DataFrame, few: int = FEW) -> DataFrame:
    """node, component (its least node) for the nodes of links (a, b: long).

    Every round each node points to its least neighbour or itself, pointers are doubled, and links
    are drawn anew between what nodes point to. The rounds grow with the logarithm of the nodes; all
    of it are joins and partial aggregates, so that nodes with very many links are no hot spot. Once
    few links are left one task joins them.
    """
    once = links.filter("a != b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
    edges = written(once, "edges")
    if edges.limit(few + 1).count() <= few:
        return written(edges.coalesce(1).mapInArrow(_joined, "node long, component long"), "labels")
    edges = written(edges.union(edges.select("v", "u")), "edges")
    labels = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    while (left := edges.limit(few + 1).count()) > few:
        to = edges.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p"))
        to = written(to, "pointers")
        for _ in range(2):
            to = written(to.join(to.select(F.col("u").alias("p"), F.col("p").alias("q")), "p").select("u", F.col("q").alias("p")), "pointers")
        labels = written(_renamed(labels, to), "labels")
        edges = edges.join(to, "u").select("v", F.col("p").alias("a")).join(to.select(F.col("u").alias("v"), F.col("p").alias("b")), "v")
        edges = written(edges.filter("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
    if left:
        last = edges.coalesce(1).mapInArrow(_joined, "node long, component long")
        labels = written(_renamed(labels, last.select(F.col("node").alias("u"), F.col("component").alias("p"))), "labels")
    return labels


def _renamed(labels: DataFrame, to: DataFrame) -> DataFrame:
    return labels.join(to.withColumnRenamed("u", "component"), "component", "left").select("node", F.coalesce("p", "component").alias("component"))
