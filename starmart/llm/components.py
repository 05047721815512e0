"""Connected components of a link table, as joins and aggregates that never leave the cluster.

Alternates the two star steps of the well-known distributed algorithm: the large star links every
larger neighbour of a node to the node's smallest neighbour, the small star every smaller one.  Both
keep the components; links between the same two nodes merge, and after a logarithmic number of
rounds each node is linked to the smallest node of its component.  Each round is written to the
shared folder, so lineage stays short and a lost executor costs one round at most.

A table of at most :data:`ONE_TASK_LINKS` links, counted first, is joined up by one task instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import few_files, materialize

#: Links that one task joins up (16 bytes each, some 200 as Python numbers).
ONE_TASK_LINKS = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links at once: union by the smaller node."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    for rb in batches:
        for a, b in zip(rb.column("a").to_pylist(), rb.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "root"])


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root``: the smallest node of its component, for every node but the roots that has a link.

    Links of a node to itself say nothing; repeated links count once; null ends are left out."""
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    rows = links.count()
    edges, last = materialize(few_files(edges, rows), "links"), None
    if dict(edges.dtypes) == {"a": "bigint", "b": "bigint"} and edges.count() <= ONE_TASK_LINKS:
        return materialize(edges.coalesce(1).mapInArrow(_joined_up, "node long, root long"), "links")
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == last or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = state
        edges = materialize(few_files(_small_star(_large_star(edges).distinct()).filter(F.col("a") != F.col("b")).distinct(), rows), "links")
