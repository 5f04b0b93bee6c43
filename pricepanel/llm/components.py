"""Connected components of a link table, by union-find and rounds of least labels.

Links are first thinned inside each partition by a union-find forest, which
keeps at most one link a node. Rounds then give every node the least label of
its neighbours and jump along labels (label of the label), so the number of
rounds follows the logarithm of a component's diameter. Every round is one
table in the shared folder; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.tables import stored
from pricepanel.session import ship_package


class UnionFind:
    """Disjoint sets with path halving; the least member is the root."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition, thinned to a spanning forest of (node, root)."""
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            sets.union(a, b)
    pairs = [(x, r) for x in list(sets.parent) if (r := sets.find(x)) != x]
    for i in range(0, len(pairs), 50_000):
        part = pairs[i:i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in part], pa.string()), pa.array([p[1] for p in part], pa.string())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link; the label is the least node reachable.

    ``links`` has string columns a and b; direction, repeats and links from a
    node to itself don't matter. An empty table gives no rows.
    """
    ship_package(links.sparkSession)
    thin = stored(links.select("a", "b").where("a <> b").mapInArrow(_forest, "a string, b string"), "links")
    both = thin.unionByName(thin.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .select(F.col("a").alias("node"), "label")
                .unionByName(labels).groupBy("node").agg(F.min("label").alias("label")))
        jumped = (near.alias("n").join(labels.alias("l"), F.col("n.label") == F.col("l.node"), "left")
                  .select(F.col("n.node"), F.coalesce("l.label", "n.label").alias("label")))
        after = stored(jumped, "labels")
        changed = after.join(labels.withColumnRenamed("label", "before"), "node").where("label <> before")
        if changed.isEmpty():
            return after
        labels = after
