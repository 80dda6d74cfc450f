"""Connected components of a link table, all in DataFrames.

First each task joins what the links it holds join, a bounded number of them,
and gives a star for each group.  Where that took one task the stars are the
components.  Otherwise large-star and small-star steps alternate until the links
no longer change; every step is a grouped minimum and a join, so no node's
neighbours are ever gathered, and each round's links are written to the shared
folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelake.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v), u > v.  Large: neighbours above a node go to the least one it sees; small: those below do."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) from each node to the least node of its group, over the links of one task."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = top(a), top(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    stars = [(x, top(x)) for x in parent]
    stars = [s for s in stars if s[0] != s[1]]
    if stars:
        u, v = zip(*stars, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def components(links: DataFrame, task_links: int = 500_000) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the least node that links lead to; ``links`` are read twice."""
    tasks = max(1, -(-links.count() // task_links))
    edges = written(links.select("a", "b").coalesce(tasks).mapInArrow(_local_stars, "u long, v long"), "links")
    state = None
    while tasks > 1:
        edges = written(_star(_star(edges, True), False), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    # a group's own least node
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
