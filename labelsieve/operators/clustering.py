"""Repeatable clustering of embeddings (k-means), the same on any partitioning.

* Seeding is farthest-first: the first centre is the item with the least md5 order
  key, each next one the item farthest from the centres so far (ties: smaller id).  A
  round is one pass that carries the distance to the nearest centre along.
* A round of Lloyd's algorithm assigns every item to its nearest centre (ties: lower
  centre) and adds up the members of each cluster in whole multiples of ``1 / UNIT``, so
  that sums do not depend on the order or the grouping of rows.
* Distances add the squared differences component by component, in order, in doubles:
  the same bits in every task, batch and in SQL.

Tasks see their own rows and the centres (``k`` vectors, bounded by ``MAX_CENTRES``
numbers); they send a sum per cluster and batch, which Spark adds up.  Nothing else is shuffled
or collected, and a cluster that holds most of the items is summed in all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_order_key
from ..params import SEED
from ..session import materialize, ship_package

UNIT = float(1 << 30)
# Components must stay below this; then a batch of 2**15 rows adds up within 64 bits.
MAX_COMPONENT = float(1 << 16)
BATCH_ROWS = 1 << 15
# Numbers in the table of centres (64 MB).
MAX_CENTRES = 8 << 20


def _vectors(items: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """Items whose vector has only finite components, with a fixed length, and that length."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    rows = items.select(F.col(f"`{id_col}`").alias("item_id"), v.alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MAX_COMPONENT))
    size = F.size("v")
    seen = rows.filter(F.col("v").isNotNull()).agg(
        F.max(size).alias("dim"), F.count_if(F.exists("v", lambda x: (F.abs(x) >= MAX_COMPONENT) &
                                                      (F.abs(x) < float("inf")))).alias("large")).first()
    if seen["large"]:
        raise ValueError(f"vectors must have components below {MAX_COMPONENT:.0f}; scale them first")
    return rows.filter(F.col("item_id").isNotNull() & F.col("v").isNotNull() & sound), seen["dim"] or 0


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``dim``."""
    flat, sizes = np.asarray(column.flatten()), np.diff(np.asarray(column.offsets))
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _squares(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of the rows to a centre, added in the order of the components."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        step = rows[:, j] - centre[j]
        total += step * step
    return total


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    best, at = _squares(rows, centres[0]), np.zeros(len(rows), dtype=np.int32)
    for c in range(1, len(centres)):
        d = _squares(rows, centres[c])
        closer = d < best
        best[closer], at[closer] = d[closer], c
    return best, at


def _carry(shared, dim: int):
    """Seeding: the squared distance to the nearest centre after one more centre."""
    def run(batches):
        for b in batches:
            d = _squares(_matrix(b.column(1), dim), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.minimum(np.asarray(b.column(2)), d))],
                                             names=["item_id", "v", "d"])
    return run


def _sums(shared, dim: int):
    """Lloyd: per batch the size and the component sums of each cluster."""
    def run(batches):
        centres = shared.value
        for whole in batches:
            for b in (whole.slice(i, BATCH_ROWS) for i in range(0, whole.num_rows, BATCH_ROWS)):
                rows = _matrix(b.column(1), dim)
                _, at = _nearest(rows, centres)
                units = np.rint(rows * UNIT).astype(np.int64)
                sums = np.zeros((len(centres), dim), dtype=np.int64)
                np.add.at(sums, at, units)
                n = np.bincount(at, minlength=len(centres))
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(n[some]), pa.ListArray.from_arrays(
                        pa.array(np.arange(len(some) + 1, dtype=np.int32) * dim), pa.array(sums[some].ravel()))],
                    names=["cluster", "n", "sums"])
    return run


def _assign(shared, dim: int):
    def run(batches):
        for b in batches:
            d, at = _nearest(_matrix(b.column(1), dim), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at), pa.array(np.sqrt(d))],
                                             names=["item_id", "cluster", "distance"])
    return run


def seed_centres(rows: DataFrame, k: int, dim: int, seed: int, id_type: str) -> np.ndarray:
    """Up to ``k`` centres, farthest first; fewer where there are fewer different vectors."""
    spark = rows.sparkSession

    def padded(v: list) -> np.ndarray:
        return np.array(v + [0.0] * (dim - len(v)))
    first = rows.agg(F.min_by("v", F.struct(hash_order_key(seed, "centre", F.col("item_id").cast("string")), "item_id"))).first()[0]
    if first is None:
        return np.empty((0, dim))
    centres = [padded(first)]
    state = rows.withColumn("d", F.lit(float("inf")))
    while len(centres) < k:
        carry = _carry(spark.sparkContext.broadcast(centres[-1]), dim)
        state = materialize(state.mapInArrow(carry, f"item_id {id_type}, v array<double>, d double"), "seeding")
        # The farthest item; of equally far ones the smallest id.
        far = state.agg(F.max("d")).first()[0]
        if not far:
            break
        centres.append(padded(state.filter(F.col("d") == F.lit(far)).agg(F.min_by("v", "item_id")).first()[0]))
    return np.array(centres)


def kmeans(items: DataFrame, k: int, rounds: int = 5, seed: int = SEED, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``(item_id, cluster int, distance)`` of every item with a sound vector, after ``rounds`` of Lloyd's algorithm.

    Shorter vectors count as padded with zeros; items without an id, and vectors that are null or
    hold a null or non-finite component, take no part.  A cluster that loses all its items keeps its
    centre.  Rounds end early once no centre moves.  No item gives an empty table.
    """
    if k < 1 or rounds < 0:
        raise ValueError("k must be 1 or more, rounds 0 or more")
    spark = items.sparkSession
    ship_package(spark)
    rows, dim = _vectors(items, id_col, vec_col)
    if k * dim > MAX_CENTRES:
        raise ValueError("too many centres for a broadcast table")
    rows = materialize(rows, "vectors")
    id_type = rows.schema["item_id"].dataType.simpleString()
    centres = seed_centres(rows, k, dim, seed, id_type)
    if not len(centres):
        return spark.createDataFrame([], f"item_id {id_type}, cluster int, distance double")
    for _ in range(rounds):
        parts = rows.mapInArrow(_sums(spark.sparkContext.broadcast(centres), dim), "cluster int, n long, sums array<long>")
        total = (parts.select("cluster", "n", F.posexplode("sums").alias("j", "x")).groupBy("cluster", "j")
                 .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")))
        moved = centres.copy()
        for r in total.collect():  # a row per centre and component
            moved[r["cluster"], r["j"]] = float(int(r["x"])) / UNIT / r["n"]
        if (moved == centres).all():
            break
        centres = moved
    return rows.mapInArrow(_assign(spark.sparkContext.broadcast(centres), dim),
                           f"item_id {id_type}, cluster int, distance double")
