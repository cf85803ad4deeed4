"""Connected components of links between integer ids: local union-find, then large-star / small-star rounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialize

MAX_ROUNDS = 100


def _forest(batches):
    """Union-find over the links of one task: ``(u, root)`` for every id that is not its own root."""
    links = [np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
    if not links:
        return
    links = np.concatenate(links)
    ids, at = np.unique(links, return_inverse=True)
    parent = list(range(len(ids)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in at.reshape(-1, 2).tolist():
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)  # the root is the least id
    roots = np.array([find(i) for i in range(len(ids))])
    keep = roots != np.arange(len(ids))
    if keep.any():
        yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(ids[roots[keep]])], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) -> ``(id, component)`` of every linked id but the least of its component.

    Each task first reduces its links to a forest.  Then rounds of large-star (every
    larger neighbour of an id goes to the least neighbour) and small-star (the same
    with the smaller ones) run until nothing changes; each is a minimum per id, summed
    up before the shuffle, and one join.
    """
    edges = materialize(arrow_map(links.select(F.col("u").cast("long"), F.col("v").cast("long")), _forest,
                                  "u long, v long"), "forest")  # u > v
    state = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u > v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, "stars")
        new = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
